"""Licence scan by sentence rules.

A text is cut into fragments at line ends and after sentence ends. One fragment, or several in a row
where a sentence is wrapped over lines, is normalised (lower case; comment marks, punctuation and
copyright lines' spacing dropped; British and American spelling made one) and looked up among known
licence sentences. ``{}`` in a sentence stands for a name of up to ``NAME`` words. The identifiers found,
in text order, are matched against rules: a rule is an ordered sequence of identifiers, and it holds where
these follow each other with no other identifier and no unknown text between, only empty lines, list marks
and copyright lines. So a licence with a clause that no sentence covers gets no name in place of a wrong
one. A rule inside a longer rule that holds at the same place doesn't count.

Defined results: a null or empty text has no sentences and no licence; a licence named twice is
listed once; repeated rows get equal results; an empty table gives an empty result. Input columns with
the names of result columns are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from .common import annotate

# Sentences of public licence texts and notices, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-notice": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Distributed under the MIT License.",
        "SPDX-License-Identifier: MIT"),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",),
    "mit-keep": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",),
    "as-is-expressed": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NON-INFRINGEMENT."),
    "apache2-notice": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "SPDX-License-Identifier: Apache-2.0"),
    "apache2-obey": (
        "you may not use this file except in compliance with the License.",),
    "apache2-copy": (
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",),
    "apache2-as-is": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",),
    "gpl3-notice": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "This program is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only"),
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",),
    "gpl2-free": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",),
    "gpl-no-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "gpl3-later-notice": ("SPDX-License-Identifier: GPL-3.0-or-later",),
    "gpl2-later-notice": ("SPDX-License-Identifier: GPL-2.0-or-later",),
    "gpl2-only": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License, version 2, as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; version 2 of the License.",
        "SPDX-License-Identifier: GPL-2.0-only"),
    "lgpl21-free": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "lgpl21-only": ("SPDX-License-Identifier: LGPL-2.1-only",),
    "lgpl3-free": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0-or-later"),
    "lgpl3-only": ("SPDX-License-Identifier: LGPL-3.0-only",),
    "agpl3-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later"),
    "agpl3-only": ("SPDX-License-Identifier: AGPL-3.0-only",),
    "mpl2-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "mpl2-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "isc-notice": ("SPDX-License-Identifier: ISC",),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "isc-as-is": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND {} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",),
    "unlicense-notice": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense"),
    "bsd2-notice": ("SPDX-License-Identifier: BSD-2-Clause",),
    "bsd3-notice": ("SPDX-License-Identifier: BSD-3-Clause",),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Neither the name of {} nor the names of {} may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
        "Neither the names of {} nor the names of {} may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
        "The name of {} may not be used to endorse or promote products derived from this software without specific prior "
        "written permission.",
        "The names of {} may not be used to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "bsd-advertise": (
        "All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement: This product includes software developed by {}.",),
    "bsd-as-is": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED.",
        "THIS SOFTWARE IS PROVIDED BY {} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    "cc-by-nc4-notice": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by4-notice": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa4-notice": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0-notice": ("SPDX-License-Identifier: CC0-1.0", "Released under CC0 1.0."),
}
# Licences as ordered sequences of sentence identifiers.
RULES: dict[str, tuple[tuple[str, ...], ...]] = {
    "MIT": (("mit-notice",), ("mit-grant", "mit-keep", "as-is-expressed"), ("mit-grant", "mit-keep")),
    "Apache-2.0": (("apache2-notice",), ("apache2-notice", "apache2-obey"),
                   ("apache2-notice", "apache2-obey", "apache2-copy", "apache2-as-is")),
    "GPL-3.0": (("gpl3-notice",),),
    "GPL-3.0-or-later": (("gpl3-later-notice",), ("gpl-free",), ("gpl-free", "gpl-no-warranty")),
    "GPL-2.0-or-later": (("gpl2-later-notice",), ("gpl2-free",), ("gpl2-free", "gpl-no-warranty")),
    "GPL-2.0-only": (("gpl2-only",), ("gpl2-only", "gpl-no-warranty")),
    "LGPL-2.1-only": (("lgpl21-only",),),
    "LGPL-2.1-or-later": (("lgpl21-free",), ("lgpl21-free", "gpl-no-warranty")),
    "LGPL-3.0-only": (("lgpl3-only",),),
    "LGPL-3.0-or-later": (("lgpl3-free",), ("lgpl3-free", "gpl-no-warranty")),
    "AGPL-3.0-only": (("agpl3-only",),),
    "AGPL-3.0-or-later": (("agpl3-free",), ("agpl3-free", "gpl-no-warranty")),
    "MPL-2.0": (("mpl2-notice",), ("mpl2-notice", "mpl2-copy")),
    "ISC": (("isc-notice",), ("isc-grant",), ("isc-grant", "isc-as-is")),
    "Unlicense": (("unlicense-notice",),),
    "BSD-2-Clause": (("bsd2-notice",), ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"),),
    "BSD-3-Clause": (("bsd3-notice",), ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"),),
    "BSD-4-Clause": (("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse", "bsd-as-is"),),
    "CC-BY-NC-4.0": (("cc-by-nc4-notice",),),
    "CC-BY-4.0": (("cc-by4-notice",),),
    "CC-BY-SA-4.0": (("cc-by-sa4-notice",),),
    "CC0-1.0": (("cc0-notice",),),
}
ENDS = re.compile(r"(?<=[.!?;:])[\x20\x09-\x0D]+|\n")
OTHER = re.compile(r"[^a-z0-9.]+")
FIRST = re.compile(r"[^A-Za-z0-9]*([A-Za-z0-9]+)")
DOT = re.compile(r"\.(?![0-9])")
#: A list mark before a sentence of the same fragment, and normalised text that may stand inside a rule.
MARK = re.compile(r"[^A-Za-z0-9(]*\(?(?:[0-9]{1,2}|[A-Za-z]|[ivx]{2,4})\)[\x20\x09]+")
BETWEEN = re.compile(r"|[0-9]{1,2}|[a-z]|[ivx]{2,4}|and|or|all rights reserved|(copyright|c)( c| by)? [12][0-9]{3}\b.*")
#: Most words and characters of a name.
NAME, NAME_CHARS = 16, 160


def normalise(text: str) -> str:
    text = OTHER.sub(" ", DOT.sub(" ", text.lower())).replace("licence", "license")
    return " ".join(text.split())


class Scanner:
    def __init__(self, sentences: dict[str, tuple[str, ...]], rules: dict[str, tuple[tuple[str, ...], ...]]):
        forms = [(s, name) for name, several in sentences.items() for s in several]
        self.known = {normalise(s): name for s, name in forms if "{}" not in s}
        # With a name: what it begins and ends with, the whole pattern, and the identifier.
        self.named, name_of = [], " [^ ]+" + "(?: [^ ]+){0,%d} " % (NAME - 1)
        for s, name in forms:
            if "{}" in s:
                parts = [normalise(x) for x in s.split("{}")]
                pattern = name_of.join(map(re.escape, parts)).rstrip(" ")
                self.named.append((parts[0], parts[-1], re.compile(pattern), name))
        self.longest = max((len(normalise(s)) + s.count("{}") * NAME_CHARS for s, _ in forms), default=0)
        # Only fragments with a first word of a known sentence are looked at, in either spelling.
        first = {normalise(s).split()[0] for s, _ in forms}
        self.starts = first | {w.replace("license", "licence") for w in first}
        self.rules = sorted(((seq, name) for name, forms in rules.items() for seq in forms),
                            key=lambda r: (-len(r[0]), r[1]))

    def identifier(self, sentence: str) -> str | None:
        if sentence in self.known:
            return self.known[sentence]
        for head, tail, pattern, name in self.named:
            if sentence.startswith(head) and sentence.endswith(tail) and pattern.fullmatch(sentence):
                return name
        return None

    def scan(self, text: str | None) -> tuple[list[str], list[bool]]:
        """Identifiers in text order, and whether unknown text stands between each and the one before."""
        found, gaps, gap, i = [], [], False, 0
        fragments = ENDS.split(text or "")
        while i < len(fragments):
            step, best, begin = 1, None, MARK.sub("", fragments[i], count=1) if MARK.match(fragments[i]) else fragments[i]
            first = FIRST.match(begin)
            if first and first.group(1).lower() in self.starts:
                joined = ""
                for j in range(i, len(fragments)):
                    joined = f"{joined} {normalise(begin if j == i else fragments[j])}".strip()
                    if len(joined) > self.longest:
                        break
                    name = self.identifier(joined)
                    if name is not None:
                        best, step = name, j - i + 1
                if best is not None:
                    found.append(best)
                    gaps.append(gap)
                    gap = False
            if best is None and found and not gap:
                gap = not BETWEEN.fullmatch(normalise(fragments[i]))
            i += step
        return found, gaps

    def sentences(self, text: str | None) -> list[str]:
        """Identifiers in text order."""
        return self.scan(text)[0]

    def licenses(self, ids: list[str], gaps: list[bool] | None = None) -> list[str]:
        """Names of the rules that hold; at a place the longest rule wins and the scan goes on behind it."""
        names, i = set(), 0
        while i < len(ids):
            for sequence, name in self.rules:
                if tuple(ids[i:i + len(sequence)]) == sequence and not any((gaps or [])[i + 1:i + len(sequence)]):
                    names.add(name)
                    i += len(sequence)
                    break
            else:
                i += 1
        return sorted(names)


def scan_licenses(docs: DataFrame, sentences=None, rules=None, text: str = "text") -> DataFrame:
    """``docs`` without their text, with sentence_ids (in text order) and licenses (sorted names)."""
    sentences, rules = sentences or SENTENCES, rules or RULES

    def build():
        scanner = Scanner(sentences, rules)

        def work(texts):
            scanned = [scanner.scan(t) for t in texts]
            return [[ids for ids, _ in scanned], [scanner.licenses(*x) for x in scanned]]

        return work

    return annotate(docs, "sentence_ids array<string>, licenses array<string>", build, text)
