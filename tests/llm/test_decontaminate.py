import hashlib
import random
import re

from eventloom.llm.decontaminate import decontaminate
from llm_data import UGLY, docs, words


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, width):
    windows = {}
    for item, text in items:
        w = tokens(text)
        m = min(width, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add(str(item))
    out = []
    for doc, text in rows:
        w, hit, found = tokens(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if (x := windows.get(tuple(w[i:i + m]))) is not None:
                    hit.update(range(i, i + m))
                    found |= x
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def result(df, items, spark, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate(df, bench, **kw)
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out.collect()], key=repr)


ITEMS = [(1, "w1 w2 w3 w1 w2"), (2, "W1, w2; w3"), (3, "w5"), (4, "w1 w1 w1 w1 w1 w1"), (5, None), (6, "--"), (10, "w7 w8"),
         (11, "w1 w2 w3 w1 w2")]


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, rng.randrange(60), 9))) for i in range(300)] + UGLY
    want = brute(rows, ITEMS, 4)
    assert result(docs(spark, rows), ITEMS, spark, width=4) == want
    assert result(docs(spark, rows), ITEMS, spark, width=4, block_words=5) == want


def test_long_windows(spark):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, 20, 500))) for i in range(30)]
    rows = []
    for i in range(100):
        w = words(rng, 300, 500)
        if i % 3 == 0:
            passage = items[i % 30][1].split()
            w[50:50] = passage[: rng.choice((12, 13, 20))]
        rows.append((i, " ".join(w)))
    want = brute(rows, items, 13)
    assert any(w[5] for w in want) and not all(w[5] for w in want)
    assert result(docs(spark, rows), items, spark) == want


def test_defined_cases(spark):
    clash = docs(spark, UGLY, {"n_hit": "mine", "contaminated": 7})
    assert result(clash, ITEMS, spark, width=4) == brute(UGLY, ITEMS, 4)
    out = decontaminate(clash, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert out.columns.count("n_hit") == 1 and dict(out.dtypes)["n_hit"] == "bigint"
    assert all(r[2] == 0 and not r[5] for r in result(docs(spark, UGLY), [], spark))
    assert result(docs(spark, []), ITEMS, spark) == []
    assert result(docs(spark, [(1, "a b")]), [(None, "a b")], spark)[0][2] == 0
