"""Licence recognition by sentences and rules.

A text is cut at sentence ends and line ends; normalised sentences (lower case,
words only) are looked up among known licence sentences; the sequence of their
identifiers is matched against ordered rules, longest first. A sentence may run
over several lines and have names of persons or bodies in it. Each licence named
in an SPDX line counts as a sentence. Identifiers that no rule takes are reported
as incomplete.

One Arrow pass over the texts, no shuffle. Texts without any stem that every
known sentence has are not cut at all.

Defined results: a null or empty text has no sentences and no licences; repeated
rows are scanned one by one; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.llm.common import append_struct, worker_cache

_words = re.compile(r"[a-z0-9]+")
_ends = re.compile(r"[.!?;:](?=\s|$)|\n", re.MULTILINE)
#: The mark of a condition in a list; "1." is a cut of its own.
_mark = re.compile(r"\s*(?:[*#/-]+\s*)?\(?[a-z0-9]\)\s+", re.IGNORECASE | re.ASCII)


def normalise(sentence: str) -> str:
    return " ".join(_words.findall(sentence.lower()))


#: Short name, full names and versions of the GNU licences (fixed values).
_GNU = (("GPL", ("GNU General Public License",)), ("LGPL", ("GNU Lesser General Public License", "GNU Library General Public License")), ("AGPL", ("GNU Affero General Public License",)))
_GNU_VERSIONS = {"1": "1", "2": "2", "2.1": "2.1", "3": "3", "1.0": "1", "2.0": "2", "3.0": "3"}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}

#: Sentences of the public licence texts; ``{}`` stands for a name, at most ``MOST_NAME`` words long.
BODIES = {
    "MIT_grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    "MIT_notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software",
    ),
    "MIT_warranty": (
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    ),
    "MIT_liability": (
        "In no event shall {} be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",
    ),
    "X11_name": (
        "Except as contained in this notice, the name of {} shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from {}",
        "Except as contained in this notice, the name(s) of {} shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization",
    ),
    "ISC_grant": tuple(
        f"Permission to use, copy, modify, {both} distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
        for both in ("and/or", "and")
    ),
    "0BSD_grant": tuple(
        f"Permission to use, copy, modify, {both} distribute this software for any purpose with or without fee is hereby granted" for both in ("and/or", "and")
    ),
    "ISC_warranty": (
        "The software is provided \"as is\" and {} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    ),
    "ISC_liability": (
        "In no event shall {} be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software",
    ),
    "BSD_grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "BSD_source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer, without modification",
        "Redistributions of source code must retain the above copyright notice unmodified, this list of conditions and the following disclaimer",
    ),
    "BSD_binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "BSD_advertising": (
        "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by {}",
    ),
    "BSD_endorse": (
        "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "Neither the name of {} nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "Neither the names of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "Neither the names of {} nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "Neither the name {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "The name of {} may not be used to endorse or promote products derived from this software without specific prior written permission",
        "The names of {} may not be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "BSD_warranty": (
        "This software is provided by {} \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ),
    "BSD_liability": (
        "In no event shall {} be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage",
    ),
    "Apache_comply": ("you may not use this file except in compliance with the License",),
    "Apache_copy": (
        "You may obtain a copy of the License at",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    ),
    "Apache_warranty": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "Apache_see": ("See the License for the specific language governing permissions and limitations under the License",),
    "GNU_warranty": tuple(
        f"{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"
        for what in ("This program", "This library", "This software", "This file", "It")
    ),
    "GNU_see": tuple(f"See the {name} for more details" for _, names in _GNU for name in names),
    "GNU_received": tuple(
        f"You should have received a copy of the {name} along with {what}"
        for _, names in _GNU for name in names for what in ("this program", "this library", "this software", "this file", "{}")
    ),
    "Zlib_warranty": ("This software is provided 'as-is', without any express or implied warranty",),
    "Zlib_liability": ("In no event will {} be held liable for any damages arising from the use of this software",),
    "Zlib_grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    ),
    "Zlib_origin": ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software",),
    "Zlib_credit": tuple(
        f"If you use this software in a product, an {word} in the product documentation would be appreciated but is not required"
        for word in ("acknowledgment", "acknowledgement")
    ),
    "Zlib_altered": ("Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software",),
    "Zlib_notice": (
        "This notice may not be removed or altered from any source distribution",
        "This notice may not be removed or altered from any distribution",
    ),
    "BSL_grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    ),
    "BSL_notice": (
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor",
    ),
    "BSL_warranty": (
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose, title and non-infringement",
    ),
    "BSL_liability": (
        "In no event shall the copyright holders or anyone distributing the software be liable for any damages or other liability, whether in contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",
    ),
    "MPL-2.0_ref": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "MPL_copy": tuple(
        f"If a copy of the MPL was not distributed with this file, You can obtain one at {scheme}://mozilla.org/MPL/2.0/" for scheme in ("http", "https")
    ),
    "Unlicense_grant": ("This is free and unencumbered software released into the public domain",),
    "Unlicense_any": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ),
    "BSL-1.0_ref": ("Distributed under the Boost Software License, Version 1.0", "Licensed under the Boost Software License, Version 1.0", "Use, modification and distribution are subject to the Boost Software License, Version 1.0", "Use, modification and distribution is subject to the Boost Software License, Version 1.0"),
}
#: A name of a person or body is at most so many words long.
MOST_NAME = 24

#: SPDX identifiers by their own names and, where these tables have another, by that (fixed values).
SPDX = {
    **{i.lower(): i for i in ("MIT", "MIT-0", "X11", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSD-3-Clause-Clear", "BSD-2-Clause-Patent", "Apache-1.0", "Apache-1.1", "Apache-2.0", "Zlib", "BSL-1.0", "MPL-1.0", "MPL-1.1", "MPL-2.0", "MPL-2.0-no-copyleft-exception", "Unlicense", "CC0-1.0", "WTFPL", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "CDDL-1.0", "CDDL-1.1", "Artistic-1.0", "Artistic-2.0", "PostgreSQL", "Python-2.0", "PSF-2.0", "OpenSSL", "NCSA", "UPL-1.0", "MS-PL", "MS-RL", "AFL-3.0", "OSL-3.0", "OFL-1.1", "curl", "Ruby", "PHP-3.01", "libpng-2.0", "BlueOak-1.0.0", "MulanPSL-2.0")},
    **{f"{short}-{version}{end}".lower(): f"{short}-{_GNU_VERSIONS[version]}" for (short, _), version, end in product(_GNU, ("1.0", "2.0", "2.1", "3.0"), ("", "+", "-only", "-or-later"))},
    **{f"CC-{kind}-{version}".lower(): f"CC-{kind}-{version}" for kind, version in product(_CC, ("1.0", "2.0", "2.5", "3.0", "4.0"))},
}
_spdx = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_spdx_token = re.compile(r"[a-z0-9][a-z0-9.+-]*", re.IGNORECASE | re.ASCII)


def spdx_names(text: str) -> list[tuple[str, int, int]]:
    """(identifier, begin, end) of the licences named in SPDX lines, one for each name of an expression."""
    found = []
    for line in _spdx.finditer(text):
        last = None
        for token in _spdx_token.finditer(text, line.start(1), line.end(1)):
            word = token.group().rstrip(".-").lower()
            if last in (None, "and", "or"):
                if word in SPDX:
                    found.append((f"{SPDX[word]}_ref", line.start() if last is None else token.start(), token.start() + len(word)))
            elif last != "with" and word not in ("and", "or", "with"):
                break  # words after the expression
            last = word
    return found


def all_sentences() -> dict[str, str]:
    """Sentence to identifier, with ``{}`` for names. The sentences and names are fixed values of public licences."""
    known = {s: i for i, sentences in BODIES.items() for s in sentences}
    for verb, noun in product(("Released", "Licensed", "Distributed", "This work is licensed", "This project is licensed", "This software is released"), ("MIT License", "ISC License", "BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "Unlicense")):
        known[f"{verb} under the {noun}"] = f"{noun.removesuffix(' License').replace(' ', '-')}_ref"
    verbs = ("Released", "Licensed", "Distributed", "This work is licensed", "This program is licensed", "This software is licensed", "This file is licensed", "This project is licensed", "The ASF licenses this file to You", "licenses this file to You")
    for verb, version in product(verbs, ("1.1", "2.0")):
        for form in ("the Apache License, Version {}", "Apache License {}", "the Apache {} License"):
            for end in ("", " (the \"License\")"):
                known[f"{verb} under {form.format(version)}{end}"] = f"Apache-{version}_ref"
    for verb, (short, names), version in product(verbs[:8], _GNU, _GNU_VERSIONS):
        for name, form in product(names, ("the {}, version {}", "the {} v{}", "the {} version {}, or (at your option) any later version")):
            known[f"{verb} under {form.format(name, version)}"] = f"{short}-{_GNU_VERSIONS[version]}_ref"
    starts = ("", *(f"{what} is free software you can " for what in ("This program", "This library", "This software", "This file", "It")))
    ends = (
        "{0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version",
        "{0} as published by the Free Software Foundation, either version {1} of the License, or any later version",
        "{0} as published by the Free Software Foundation, either version {1}, or (at your option) any later version",
        "{0} as published by the Free Software Foundation, version {1} of the License",
        "{0} as published by the Free Software Foundation, version {1}",
        "{0}, version {1}, as published by the Free Software Foundation",
        "{0} version {1} only, as published by the Free Software Foundation",
        "{0} version {1} or later, as published by the Free Software Foundation",
        "{0} version {1}, or (at your option) any later version, as published by the Free Software Foundation",
    )
    for start, terms, (short, names), version in product(starts, ("terms", "terms and conditions"), _GNU, _GNU_VERSIONS):
        for name, end in product(names, ends):
            rest = f"redistribute it and/or modify it under the {terms} of the {end.format(name, version)}"
            known[(start or "you can ") + rest] = f"{short}-{_GNU_VERSIONS[version]}_ref"
    for verb, (kind, name), version in product(verbs[:8], _CC.items(), ("1.0", "2.0", "2.5", "3.0", "4.0")):
        for form in ("CC {} {}", "CC-{}-{}", "a Creative Commons {} {} License", "the Creative Commons {} {} License"):
            known[f"{verb} under {form.format(kind, version)}"] = f"CC-{kind}-{version}_ref"
        for article, area in product(("a", "the"), ("", " International", " Unported", " Generic")):
            known[f"{verb} under {article} Creative Commons {name} {version}{area} License"] = f"CC-{kind}-{version}_ref"
    return known


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier, of the sentences without a name in them."""
    return {normalise(s): i for s, i in all_sentences().items() if "{}" not in s}


def named_sentences() -> list[tuple[list[str], str]]:
    """Normalised parts around the names, and identifier, of the sentences with names in them."""
    return [([normalise(part) for part in s.split("{}")], i) for s, i in all_sentences().items() if "{}" in s]


#: Every known sentence has one of these (fixed values; checked when the tables are made).
STEMS = ("licen", "copyright", "permission", "distribut", "released", "warrant", "liable", "misrepresent", "acknowledg", "advertis")
#: Begins of longer sentences of other licences: they count at a sentence end only, not at a line end.
WHOLE = ("0BSD_grant",)


def with_tail(name: str, head: tuple[str, ...], tail: tuple[str, ...]) -> list[tuple[tuple[str, ...], str]]:
    """Rules of ``head`` and any of the sentences of ``tail``, in order."""
    return [((*head, *some), name) for n in range(len(tail) + 1) for some in combinations(tail, n)]


#: Ordered rules of several sentences; each ``X_ref`` sentence is a rule of its own besides.
SEQUENCES = (
    *with_tail("BSD-4-Clause", ("BSD_grant", "BSD_source", "BSD_binary", "BSD_advertising", "BSD_endorse"), ("BSD_warranty", "BSD_liability")),
    *with_tail("BSD-3-Clause", ("BSD_grant", "BSD_source", "BSD_binary", "BSD_endorse"), ("BSD_warranty", "BSD_liability")),
    *with_tail("BSD-2-Clause", ("BSD_grant", "BSD_source", "BSD_binary"), ("BSD_warranty", "BSD_liability")),
    (("MIT_grant", "MIT_notice", "MIT_warranty", "MIT_liability", "X11_name"), "X11"),
    *with_tail("MIT", ("MIT_grant", "MIT_notice"), ("MIT_warranty", "MIT_liability")),
    *with_tail("Apache-2.0", ("Apache-2.0_ref", "Apache_comply", "Apache_copy"), ("Apache_warranty", "Apache_see")),
    *with_tail("ISC", ("ISC_grant",), ("ISC_warranty", "ISC_liability")),
    *with_tail("0BSD", ("0BSD_grant",), ("ISC_warranty", "ISC_liability")),
    *with_tail("Unlicense", ("Unlicense_grant",), ("Unlicense_any", "MIT_warranty", "MIT_liability")),
    *with_tail("Zlib", ("Zlib_warranty", "Zlib_liability", "Zlib_grant", "Zlib_origin"), ("Zlib_credit", "Zlib_altered", "Zlib_notice")),
    *with_tail("BSL-1.0", ("BSL_grant", "BSL_notice"), ("BSL_warranty", "BSL_liability")),
    (("MPL-2.0_ref", "MPL_copy"), "MPL-2.0"),
    *(
        rule for (short, _), version in product(_GNU, sorted(set(_GNU_VERSIONS.values())))
        for rule in with_tail(f"{short}-{version}", (f"{short}-{version}_ref",), ("GNU_warranty", "GNU_see", "GNU_received"))
    ),
)


class Recogniser:
    def __init__(self) -> None:
        self.known = known_sentences()
        named = named_sentences()
        missing = [s for s in [*self.known, *(" ".join(parts) for parts, _ in named)] if not any(stem in s for stem in STEMS)]
        if missing:
            raise ValueError(f"sentences without a stem: {missing}")
        # By the last word, or the first where a name is last; a sentence that a text ends in is looked at only then.
        self.by_last: dict[str, list[tuple[str, re.Pattern[str], str]]] = {}
        self.by_opening: dict[str, list[tuple[str, re.Pattern[str], str]]] = {}
        name = rf"(?: (?!(?:spdx|licensed|released|distributed)\b)[a-z0-9]+){{0,{MOST_NAME}}}"
        for parts, found in named:
            pattern = re.compile(name.join([parts[0], *(f" {part}" if part else "" for part in parts[1:])]))
            table, key = (self.by_last, parts[-1]) if parts[-1] else (self.by_opening, parts[0])
            table.setdefault(key.split()[-1] if parts[-1] else key.split()[0], []).append((parts[0], pattern, found))
        lengths = [len(s.split()) for s in self.known]
        self.longest = max([*lengths, *(len(" ".join(parts).split()) + MOST_NAME * (len(parts) - 1) for parts, _ in named)])
        single = sorted({i for i in [*self.known.values(), *(i for _, i in named), *(f"{n}_ref" for n in SPDX.values())] if i.endswith("_ref")})
        rules = {**{(i,): i.removesuffix("_ref") for i in single}, **dict(SEQUENCES)}
        self.rules = sorted(rules.items(), key=lambda r: -len(r[0]))
        self.by_first: dict[str, list[tuple[tuple[str, ...], str]]] = {}
        for rule in self.rules:
            self.by_first.setdefault(rule[0][0], []).append(rule)

    def lookup(self, words: list[str]) -> str | None:
        sentence = " ".join(words)
        if (found := self.known.get(sentence)) is not None or not words:
            return found
        for start, pattern, found in [*self.by_last.get(words[-1], ()), *self.by_opening.get(words[0], ())]:
            if sentence.startswith(start) and pattern.fullmatch(sentence):
                return found
        return None

    def sentences(self, text: str) -> list[tuple[str, int, int]]:
        """(identifier, begin, end) of the known sentences, in order, not overlapping."""
        low = text.lower()
        if not any(stem in low for stem in STEMS):
            return []
        cuts = [(m.start(), m.end(), m.group() != "\n") for m in _ends.finditer(text)] + [(len(text), len(text), True)]
        # Lower case can be longer than the text, so the words are those of each slice.
        parts = [_words.findall(text[a:b].lower()) for a, b in zip([0, *(c[1] for c in cuts)], (c[0] for c in cuts))]
        found, begin, k = spdx_names(text), 0, 0
        while k < len(cuts):
            if mark := _mark.match(text, begin, cuts[k][0]):
                begin = mark.end()
                parts[k] = parts[k][1:]
            words: list[str] = []
            hit = None
            for j in range(k, len(cuts)):
                words += parts[j]
                if len(words) > self.longest:
                    break
                if hit is not None and not parts[j] and not cuts[j][2]:
                    break  # an empty line
                if (name := self.lookup(words)) is not None and (cuts[j][2] or name not in WHOLE):
                    hit = (name, j)
                if cuts[j][2] and words:
                    # an abbreviation such as "v. 2.0" may go on; a longer known sentence decides
                    if hit is not None or len(words) > self.longest:
                        break
            if hit is not None:
                start = begin + len(text[begin : cuts[hit[1]][0]]) - len(text[begin : cuts[hit[1]][0]].lstrip())
                found.append((hit[0], start, cuts[hit[1]][0]))
                k = hit[1]
            begin = cuts[k][1]
            k += 1
        return sorted(found, key=lambda f: f[1:])

    def licences(self, ids: list[str]) -> tuple[list[str], list[str]]:
        """(licences in order, identifiers that no rule took)."""
        taken, left, k = [], [], 0
        while k < len(ids):
            for sequence, name in self.by_first.get(ids[k], ()):
                if tuple(ids[k : k + len(sequence)]) == sequence:
                    taken.append(name)
                    k += len(sequence)
                    break
            else:
                left.append(ids[k])
                k += 1
        return taken, left


SCHEMA = "n_sentences long, sentence_ids string, licences string, incomplete string, spans string"


def licences_column(text: Column) -> Column:
    """Struct: known sentences, distinct licences (sorted), identifiers left over, code-point spans."""
    names = [p.split()[0] for p in SCHEMA.split(", ")]
    types = [pa.int64()] + [pa.string()] * 4

    @F.arrow_udf(SCHEMA)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        recogniser = worker_cache("licence_recogniser", Recogniser)
        for batch in batches:
            rows = []
            for text in batch.to_pylist():
                found = recogniser.sentences(text or "")
                ids = [f[0] for f in found]
                taken, left = recogniser.licences(ids)
                rows.append((len(ids), ",".join(ids), ",".join(sorted(set(taken))), ",".join(left), ",".join(f"{i}:{a}:{b}" for i, a, b in found)))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return scan(text)


def find_licences(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the sentences, licences and what is left over."""
    return append_struct(docs, licences_column(F.col("text")))
