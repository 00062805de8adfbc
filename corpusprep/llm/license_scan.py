"""License scans by conditional compression.

1. A wording of which at most d words differ, cut into d + 1 pieces, has one piece unchanged. Places where a piece
   occurs give the windows in which the wording can be; overlapping windows are one candidate block.
2. The block is compressed alone and with every wording as raw zstandard dictionary; wordings are ranked by the bytes
   that they save.
3. In that order each wording is confirmed, or not, by its exact differences in words; a confirmed span is taken out
   and the next wording gets the rest. Names, versions and distinguishing clauses (in braces) may not differ at all,
   and a negation in or before a wording is no confirmation.
4. Around license words that no confirmed wording covers, the wording that shrinks the surroundings most is named,
   unconfirmed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met"
)
_BSD_CLAUSES = (
    ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. {Redistributions in binary form must reproduce the above copyright notice}, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_ENDORSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to {endorse or promote "
    "products derived from this software without specific prior written permission}. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED."
)
#: Wordings of public licenses and of the notices that name them; what stands in braces may not differ. (Fixed values.)
TEMPLATES = {
    "MIT-notice": "Released under the {MIT License}.",
    "MIT": _GRANT
    + ", subject to the following conditions: The above copyright notice and this permission notice {shall be included "
    "in all copies or substantial portions of the Software}.",
    "MIT-grant": _GRANT + ".",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that {the above copyright notice and this permission notice appear in all copies}."
    ),
    "BSD-2-Clause": _BSD + _BSD_CLAUSES + _BSD_END,
    "BSD-3-Clause": _BSD + _BSD_CLAUSES + _BSD_ENDORSE + _BSD_END,
    "BSD-opening": _BSD + ".",
    "Apache-2.0": "Licensed under the {Apache License, Version 2.0}.",
    "GPL-2.0": "This work is {licensed under the GNU General Public License, version 2}.",
    "GPL-3.0": "This work is {licensed under the GNU General Public License, version 3}.",
    "AGPL-3.0": "This work is {licensed under the GNU Affero General Public License, version 3}.",
    "LGPL-3.0": "This work is {licensed under the GNU Lesser General Public License, version 3}.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}.",
    "CC-BY-4.0": "Licensed under {CC BY 4.0}.",
    "CC-BY-SA-4.0": "Licensed under {CC BY-SA 4.0}.",
    "CC-BY-NC-4.0": "Licensed under {CC BY-NC 4.0}.",
    "CC0-1.0": "Licensed under {CC0 1.0}.",
}
#: Words that turn a wording into its opposite, and how many words before it they are looked for. (Fixed values.)
NEGATIONS, BEFORE = frozenset("not never no nor neither cannot isn aren wasn don doesn".split()), 4
#: License words: where no wording is confirmed around one, the likeliest is named. (Fixed value.)
_TRIGGER = r"licen[sc]|copyright|permission|redistribution"
_WORD = re.compile(r"[^\W_]+(?:[.\-/][^\W_]+)*")


@dataclass(frozen=True)
class LicenseScan:
    """``templates``: wordings by name; braces mark what may not differ. ``differing``: words that may differ elsewhere,
    as a share of the wording's words, rounded down."""

    templates: dict[str, str] = field(default_factory=lambda: TEMPLATES)
    differing: float = 0.1
    level: int = 6


def words_of(text: str) -> list[re.Match]:
    return list(_WORD.finditer(text))


@dataclass(frozen=True)
class Differences:
    """Words of the wording that the block lacks and words the block has in between; first and last place in the block;
    the stretches of the wording that the block has unchanged."""

    changes: list[str]
    first: int
    last: int
    kept: list[tuple[int, int]]


def differences(template: list[str], block: list[str]) -> Differences:
    found = [m for m in SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
    if not found:
        return Differences([f"-{w}" for w in template], 0, len(block), [])
    kept = {i for m in found for i in range(m.a, m.a + m.size)}
    used = {j for m in found for j in range(m.b, m.b + m.size)}
    first, last = found[0].b, found[-1].b + found[-1].size
    changes = [f"-{w}" for i, w in enumerate(template) if i not in kept]
    changes += [f"+{block[j]}" for j in range(first, last) if j not in used]
    return Differences(changes, first, last, [(m.a, m.a + m.size) for m in found])


class Wording:
    """A template: its words, the stretches that may not differ, how many words may, its pieces and its compressor."""

    def __init__(self, name: str, marked: str, how: LicenseScan):
        self.name, self.text = name, re.sub("[{}]", "", marked)
        self.words, self.fixed, at = [], [], 0
        for part in re.split("([{}])", marked):
            if part == "{":
                at = len(self.words)
            elif part == "}":
                self.fixed.append((at, len(self.words)))
            else:
                self.words += [w[0].lower() for w in words_of(part)]
        if not self.words:
            raise ValueError(f"the wording of {name} has no words")
        self.allowed = int(how.differing * len(self.words))
        cuts = [len(self.words) * k // (self.allowed + 1) for k in range(self.allowed + 2)]
        self.pieces = [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        shared = zstandard.ZstdCompressionDict(self.text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=how.level, dict_data=shared)

    def fits(self, found: Differences) -> bool:
        """Few differing words, no negation among them, and all fixed stretches unchanged."""
        return (
            len(found.changes) <= self.allowed
            and not any(c[1:] in NEGATIONS for c in found.changes)
            and all(any(a <= x and y <= b for a, b in found.kept) for x, y in self.fixed)
        )


def anchors(how: LicenseScan) -> str:
    """Pattern that every text with a confirmable wording matches: license words, or a piece's longest word."""
    license_word, longest = re.compile(_TRIGGER, re.IGNORECASE), set()
    for name, marked in how.templates.items():
        for _, piece in Wording(name, marked, how).pieces:
            if not any(license_word.search(w) for w in piece):
                longest.add(max(piece, key=lambda w: (len(w), w)))
    return "|".join([_TRIGGER, *map(re.escape, sorted(longest))])


class Scanner:
    def __init__(self, how: LicenseScan):
        self.plain = zstandard.ZstdCompressor(level=how.level)
        self.known = [Wording(name, marked, how) for name, marked in how.templates.items()]
        self.trigger = re.compile(_TRIGGER, re.IGNORECASE)
        self.starts: dict[str, list[tuple[int, int, list[str]]]] = {}
        for number, wording in enumerate(self.known):
            for at, piece in wording.pieces:
                self.starts.setdefault(piece[0], []).append((number, at, piece))

    def saved(self, number: int, data: bytes) -> tuple[int, int]:
        """Bytes of the data compressed alone, and with the wording."""
        return len(self.plain.compress(data)), len(self.known[number].packer.compress(data))

    def windows(self, block: list[str]) -> list[tuple[int, int, int]]:
        """``first word, last word, number`` of stretches that hold a piece of a wording and so may hold all of it."""
        found = set()
        for i, word in enumerate(block):
            for number, at, piece in self.starts.get(word, ()):
                if block[i : i + len(piece)] == piece:
                    wording = self.known[number]
                    low, high = i - at - wording.allowed, i - at + len(wording.words) + wording.allowed
                    found.add((max(0, low), min(len(block), high), number))
        return sorted(found)

    def negated(self, text: str, spans: list[re.Match], block: list[str], first: int) -> bool:
        """Whether a negation stands shortly before the wording in its sentence."""
        for j in range(max(0, first - BEFORE), first):
            if block[j] in NEGATIONS and not re.search(r"[.!?;]\s|\n\s*\n", text[spans[j].end() : spans[first].start()]):
                return True
        return False

    def confirmed(self, text: str, spans: list[re.Match], block: list[str]) -> list[tuple[Differences, int]]:
        """Wordings found, block by block, with their numbers; places count words of the text."""
        kept: list[tuple[Differences, int]] = []
        windows, at = self.windows(block), 0
        while at < len(windows):
            begin, end, till = windows[at][0], windows[at][1], at + 1
            while till < len(windows) and windows[till][0] < end:
                end, till = max(end, windows[till][1]), till + 1
            by_number: dict[int, list[tuple[int, int]]] = {}
            for a, b, number in windows[at:till]:
                by_number.setdefault(number, []).append((a, b))
            data = text[spans[begin].start() : spans[end - 1].end()].lower().encode()
            alone = len(self.plain.compress(data))
            ranked = sorted(
                (len(w.packer.compress(data)) - alone, -len(w.words), w.name, number) for number, w in enumerate(self.known)
            )
            taken: set[int] = set()
            for *_, number in ranked:
                wording = self.known[number]
                for a, b in by_number.get(number, ()):
                    # A word that a confirmed wording has taken ends the window.
                    free = [j for j in range(a, b) if j not in taken]
                    if len(free) < len(wording.words) - wording.allowed:
                        continue
                    rest = [block[j] if j not in taken else "" for j in range(a, b)]
                    found = differences(wording.words, rest)
                    first, last = a + found.first, a + found.last
                    if wording.fits(found) and not self.negated(text, spans, block, first):
                        taken.update(range(first, last))
                        kept.append((Differences(found.changes, first, last, found.kept), number))
            at = till
        return kept

    def likeliest(self, text: str, spans: list[re.Match], block: list[str], at: int) -> tuple[Differences, int]:
        """The wording that shrinks the surroundings of the word most, with the surroundings as words."""
        ranked = []
        for number, wording in enumerate(self.known):
            size = len(wording.words)
            a, b = max(0, at - size), min(len(block), at + size + 1)
            alone, given = self.saved(number, text[spans[a].start() : spans[b - 1].end()].lower().encode())
            ranked.append(((alone - given) / alone, size, wording.name, a, b, number))
        _, _, _, a, b, number = max(ranked)
        found = differences(self.known[number].words, block[a:b])
        return Differences(found.changes, a, b, found.kept), number

    def scan(self, text: str) -> list[dict]:
        spans = words_of(text)
        block, starts = [w[0].lower() for w in spans], [w.start() for w in spans]
        places = sorted({bisect_right(starts, m.start()) - 1 for m in self.trigger.finditer(text)})
        sure = self.confirmed(text, spans, block)
        covered = {i for found, _ in sure for i in range(found.first, found.last)}
        unsure: list[tuple[Differences, int]] = []
        for at in places:
            if at in covered:
                continue
            row = self.likeliest(text, spans, block, at)
            # Overlapping surroundings with the same license are one block; the closer one stands for it.
            if unsure and unsure[-1][1] == row[1] and row[0].first < unsure[-1][0].last:
                row = min(row, unsure.pop(), key=lambda r: len(r[0].changes))
            unsure.append(row)
        found = []
        rows = [(r, True) for r in sure] + [(r, False) for r in unsure]
        for (differing, number), is_sure in sorted(rows, key=lambda r: (r[0][0].first, r[0][0].last, r[0][1])):
            a, b = spans[differing.first].start(), spans[differing.last - 1].end()
            alone, given = self.saved(number, text[a:b].lower().encode())
            found.append(
                {
                    "license": self.known[number].name,
                    "start": a,
                    "end": b,
                    "bytes_alone": alone,
                    "bytes_given": given,
                    "reduction": round((alone - given) / alone, 6),
                    "n_differences": len(differing.changes),
                    "differences": " ".join(differing.changes),
                    "confirmed": is_sure,
                }
            )
        return found


_FOUND = (
    "license string, start int, end int, bytes_alone int, bytes_given int, reduction double, n_differences int, "
    "differences string, confirmed boolean"
)


def license_scan(docs: DataFrame, how: LicenseScan = LicenseScan()) -> DataFrame:
    """One row per license wording confirmed, also across lines, and one per block around other license words with the
    license that compresses it best, unconfirmed.

    Of overlapping wordings the one whose dictionary saves most of the candidate block counts; equal savings go to the
    longer wording, then by name. ``start`` and ``end`` are the block in characters, ``differences`` its wording
    against the license's. A text of any length is scanned whole, by one task, in time linear in its words. Texts
    without a license word or wording, null and empty ones have no row. Repeated rows are scanned as often as they
    come, a null doc_id stays null, other columns are ignored; an empty table gives an empty result.
    """
    kinds = pa.struct(
        [
            ("license", pa.string()),
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("bytes_alone", pa.int32()),
            ("bytes_given", pa.int32()),
            ("reduction", pa.float64()),
            ("n_differences", pa.int32()),
            ("differences", pa.string()),
            ("confirmed", pa.bool_()),
        ]
    )

    def run(batches):
        scanner = Scanner(how)
        for piece in pieces(batches, "text"):
            ids, rows = [], []
            for doc_id, text in zip(piece["doc_id"].to_pylist(), piece["text"].to_pylist(), strict=True):
                for row in scanner.scan(text or ""):
                    ids.append(doc_id)
                    rows.append(row)
            flat = pa.array(rows, kinds).flatten()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *flat], names=["doc_id", *[f.name for f in kinds]])

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Most texts have no license word; they never leave the JVM.
    likely = asked.filter(F.col("text").rlike(f"(?i){anchors(how)}"))
    return likely.mapInArrow(run, f"doc_id long, {_FOUND}")
