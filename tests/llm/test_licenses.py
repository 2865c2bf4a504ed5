from eventloom.llm.licenses import RULES, SENTENCES, Scanner, normalise, scan_licenses
from llm_data import UGLY, docs

MIT = "\n".join(SENTENCES[k][0] for k in ("mit-grant", "mit-keep", "as-is-expressed"))
BSD3 = " ".join(SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"))
BSD2 = " ".join(SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"))


def wrap(text, width=60, mark="// "):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(mark + line)
            line = ""
        line = f"{line} {word}".strip()
    return "\n".join([*lines, mark + line])


CASES = [
    ("Prose ends.\nReleased under the MIT License.\nMore prose.", ["MIT"]),
    (MIT, ["MIT"]), (wrap(MIT), ["MIT"]), (wrap(BSD3, 40, " * "), ["BSD-3-Clause"]), (BSD2, ["BSD-2-Clause"]),
    (" ".join(SENTENCES[k][0] for k in ("bsd-source", "bsd-grant", "bsd-binary", "bsd-as-is")), []),
    ("This work is licensed under the GNU General Public Licence, version 3.", ["GPL-3.0"]),
    ("Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.", ["Apache-2.0", "CC-BY-NC-4.0"]),
    ("We talked about the MIT License.", []), ("SPDX-License-Identifier: Apache-2.0\nint x;", ["Apache-2.0"]),
    ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
]


def test_cases(spark):
    rows = [(i, text) for i, (text, _) in enumerate(CASES)]
    out = {r.doc_id: r for r in scan_licenses(docs(spark, rows, {"licenses": "clash"})).collect()}
    for i, (text, want) in enumerate(CASES):
        assert out[i].licenses == want, text
    assert out[1].sentence_ids == ["mit-grant", "mit-keep", "as-is-expressed"]


def test_against_every_stretch_of_words():
    """Sentences found by trying all stretches of fragments, from each start the longest."""
    scanner = Scanner(SENTENCES, RULES)
    known = {normalise(s): k for k, forms in SENTENCES.items() for s in forms}
    import re
    for text, _ in CASES:
        parts = [normalise(p) for p in re.split(r"(?<=[.!?;:])[\x20\x09-\x0D]+|\n", text)]
        found, i = [], 0
        while i < len(parts):
            ends = [j for j in range(i + 1, len(parts) + 1) if parts[i] and " ".join(p for p in parts[i:j] if p) in known]
            found += [known[" ".join(p for p in parts[i:max(ends)] if p)]] if ends else []
            i = max(ends) if ends else i + 1
        assert scanner.sentences(text) == found


def test_defined_cases(spark):
    rows = UGLY + [(50, "Licensed under CC BY-NC 4.0.\n" * 3)]
    out = scan_licenses(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.licenses == (["CC-BY-NC-4.0"] if r.doc_id == 50 else [])
    assert scan_licenses(docs(spark, [])).collect() == []


def test_own_rules(spark):
    out = scan_licenses(docs(spark, [(1, "Be kind. Share alike. Be kind.")]), {"k": ("Be kind.",), "s": ("Share alike.",)},
                        {"both": (("k", "s"),), "kind": (("k",),)}).first()
    assert out.sentence_ids == ["k", "s", "k"] and out.licenses == ["both", "kind"]


def full(*ids):
    return "\n".join(SENTENCES[k][0] for k in ids)


def named(text):
    scanner = Scanner(SENTENCES, RULES)
    return scanner.licenses(*scanner.scan(text))


def test_a_holder_by_name_does_not_make_it_another_licence(spark):
    text = BSD3.replace("the copyright holder", "Example Corp. Ltd.").replace("its contributors", "other contributors")
    text = text.replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE REGENTS")
    marked = text.replace("Redistributions of", "(1) Redistributions of").replace("Redistributions in", "2. Redistributions in")
    rows = [(1, text), (2, wrap(text, 50, " * ")), (3, marked)]
    assert {r.doc_id: r.licenses for r in scan_licenses(docs(spark, rows)).collect()} == dict.fromkeys((1, 2, 3), ["BSD-3-Clause"])


def test_unknown_clause_inside_gives_no_licence():
    parts = [SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")]
    assert named("\n".join([*parts[:3], "Nobody may use this on a Sunday.", parts[3]])) == []
    assert named("\n".join([parts[0], "", "1.", parts[1], "2.", parts[2], "Copyright (c) 2011 Some One", parts[3]])) == ["BSD-2-Clause"]
    # The name is bounded, so a clause isn't taken for one.
    assert named(BSD3.replace("the copyright holder", "a " * 17)) == []


def test_more_licences():
    for ids, want in [(("lgpl21-free", "gpl-no-warranty"), "LGPL-2.1-or-later"), (("lgpl3-free",), "LGPL-3.0-or-later"),
                      (("agpl3-free", "gpl-no-warranty"), "AGPL-3.0-or-later"), (("mpl2-notice", "mpl2-copy"), "MPL-2.0"),
                      (("gpl2-only", "gpl-no-warranty"), "GPL-2.0-only"), (("unlicense-notice",), "Unlicense")]:
        text = "Prose.\n" + full(*ids) + "\nMore prose."
        assert named(text) == [want] and named(wrap(full(*ids), 50, "# ")) == [want], ids
    isc = full("isc-grant", "isc-as-is").replace("{}", "THE AUTHOR")
    assert named(isc) == named(wrap(isc)) == ["ISC"]
    assert named(full("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse", "bsd-as-is")
                 .replace("{}", "the University")) == ["BSD-4-Clause"]
    for names in RULES:
        if f"SPDX-License-Identifier: {names}" in sum(SENTENCES.values(), ()):
            assert named(f"// SPDX-License-Identifier: {names}\n") == [names]
