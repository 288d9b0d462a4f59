"""License scan: exact base phrases, and fuzzy search for short notices with bounded edits."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Notices of the fuzzy search as (label, words, most edits in characters).
NOTICES = [
    ("agpl", "gnu affero general public license", 2),
    ("all-rights-reserved", "all rights reserved", 1),
    ("apache", "licensed under the apache license", 2),
    ("bsd", "redistribution and use in source and binary forms", 3),
    ("cc-by", "creative commons attribution", 2),
    ("cc-by-nc", "licensed under cc by nc", 1),
    ("cc-by-sa", "licensed under cc by sa", 1),
    ("cc0", "dedicated to the public domain", 2),
    ("gpl", "gnu general public license", 2),
    ("lgpl", "gnu lesser general public license", 2),
    ("mit", "released under the mit license", 2),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 4),
    ("mpl", "mozilla public license", 2),
]

# Words: what stands between bytes 00-2F, 3A-60 and 7B-7F, once A-Z are lower-cased.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SCHEMA = (
    "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,first_word:long,last_word:long,edits:int>>"
)


def pieces(words: str, edits: int) -> list[tuple[int, str]]:
    """Cuts a notice into edits + 1 pieces; of any text within that many edits at least one piece occurs unchanged."""
    n = edits + 1
    cuts = [len(words) * k // n for k in range(n + 1)]
    return [(a, words[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Scanner:
    """Finds base phrases and notices in one text at a time."""

    def __init__(self, base: dict[str, str], notices: list[tuple[str, str, int]]):
        self.base = [(f" {k} ".encode(), v, len(k.split())) for k, v in base.items()]
        self.notices = [(label, len(words), edits, regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(words, literal_spaces=True)}){{e<={edits}}}(?![^ ])")) for label, words, edits in notices]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, words, edits) in enumerate(notices):
            for at, piece in pieces(words, edits):
                places.setdefault(piece, []).append((k, at))
        self.seeds = ahocorasick.Automaton()
        for piece, where in places.items():
            self.seeds.add_word(piece, (len(piece), where))
        if places:
            self.seeds.make_automaton()
        self.empty = not places

    def base_places(self, joined: bytes) -> list[tuple[int, str, int]]:
        """(first word, label, words) of every place of a base phrase, in order."""
        found = []
        for phrase, label, n in self.base:
            at, seen, words = joined.find(phrase), 0, 0
            while at >= 0:
                words += joined.count(b" ", seen, at)
                seen = at
                found.append((words, label, n))
                at = joined.find(phrase, at + 1)
        return sorted(found)

    def notice_places(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """(start, end, label, edits, length of the notice) of every notice within its bound of edits."""
        if self.empty:
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.seeds.iter(text):
            for k, at in where:
                _, n, edits, _ = self.notices[k]
                # one character more in front: the matcher allows no insertion where its search starts
                a, b = max(0, end - size - at - edits), end + 1 - size - at + n + edits
                own = windows.setdefault(k, [])
                if own and a <= own[-1][1]:
                    own[-1][1] = max(b, own[-1][1])
                else:
                    own.append([a, b])
        found = []
        for k, own in windows.items():
            label, n, edits, pattern = self.notices[k]
            for a, b in own:
                stop = text.find(" ", b + 1)  # a window ends where a word does
                for m in pattern.finditer(text, a, len(text) if stop < 0 else stop):
                    found.append((m.start(), m.end(), label, sum(m.fuzzy_counts), n))
        return sorted(found)

    def scan(self, text: str | None) -> dict:
        words = (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()
        joined = b" " + b" ".join(words) + b" "
        base = self.base_places(joined)
        labels = {label for _, label, _ in base}
        spans = [{"label": label, "first_word": at, "last_word": at + n - 1, "edits": 0} for at, label, n in base]
        plain = joined[1:-1].decode("utf-8", "replace")
        near = self.notice_places(plain)
        score = 1.0 if base else 0.0
        for a, b, label, edits, n in near:
            first = plain.count(" ", 0, a)
            spans.append({"label": label, "first_word": first, "last_word": first + plain.count(" ", a, b), "edits": edits})
            score = max(score, 1.0 - edits / n)
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": base[0][0] if base else None,
            "last_word": base[-1][0] if base else None,
            "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(labels | {label for _, _, label, _, _ in near})),
            "score": score,
            "spans": spans,
        }


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None, notices: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """One row per document: counts and places of base phrases, labels of base phrases and fuzzy notices, spans.

    A notice is found by the pigeonhole rule: cut into edits + 1 pieces, one piece must stand unchanged in the text.
    An Aho-Corasick pass finds all pieces of all notices, and the fuzzy matcher of `regex` confirms the bounded
    number of edits in a window around each. Spans count words from 0, both ends included.

    score: 1 for a base phrase or an unchanged notice, else 1 - edits / length of the closest notice, else 0.
    Null or empty text: no words, no labels, first_word and last_word null. Null ids and repeated rows are kept as
    they are. Other columns are not read; an empty table gives no rows. Texts of any length are read whole, one at a
    time; nothing is shuffled.
    """
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = [{"id": i, **scanner.scan(t)} for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = pa.schema(
        [("id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
         ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])))]
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)
