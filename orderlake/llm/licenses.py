"""License scans: short notices, also with typing errors.

A notice of some length may hold up to ``errors`` edits. Cut into one piece more
than that, at least one piece stands unchanged in any such text (pigeonhole), so
the pieces are looked up exactly, in one pass of an automaton, and only the
surroundings of their places are matched by the regex library with bounded
errors. Key words of a notice (a name, a version) must stand as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Phrases whose exact places every scan reports, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices to find with errors, their labels, and the words that must not differ.
NOTICES = [
    ("under the mit license", "mit", ["mit"]),
    ("permission is hereby granted free of charge", "mit", []),
    ("apache license version 2", "apache-2", ["2"]),
    ("creative commons attribution noncommercial", "cc-by-nc", []),
    ("creative commons attribution sharealike", "cc-by-sa", []),
    ("gnu general public license", "gpl", ["gnu"]),
    ("gnu lesser general public license", "lgpl", ["gnu"]),
    ("mozilla public license", "mpl", []),
    ("redistribution and use in source and binary forms", "bsd", []),
]
#: One edit for so many characters of a notice.
CHARS_AN_EDIT = 10
#: Characters normalised at a time; a longer text is one of its own.
SLICE_CHARS = 2_000_000
MAX_REMEMBERED = 50_000

_SCAN = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, "
    "matches array<struct<label:string,word:bigint,edits:int,text:string>>"
)
#: A-Z lower-cased; every other ASCII character that is no letter or digit parts words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def normalised(text: str | None) -> str:
    """The words with a space before and after each, or a single space."""
    words = (text or "").encode().translate(_FOLD).split(b" ")
    return " " + "".join([w.decode() + " " for w in words if w])


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    errors: int
    pattern: str

    @classmethod
    def of(cls, text: str, label: str, keys: list[str], chars_an_edit: int) -> Notice:
        import regex

        errors, parts, loose = len(text) // chars_an_edit, [], []

        def close() -> None:
            if loose:
                parts.append(f"(?:{regex.escape(' '.join(loose), literal_spaces=True)}){{e<={errors}}}")
                loose.clear()

        for word in text.split(" "):
            if word in keys:
                close()
                parts.append(regex.escape(word))
            else:
                loose.append(word)
        close()
        return cls(text, label, errors, "(?b) " + " ".join(parts) + "(?= )")

    def pieces(self) -> list[tuple[int, str]]:
        """``errors + 1`` pieces of even length with their places in the notice."""
        n, size = self.errors + 1, len(self.text)
        cuts = [i * size // n for i in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """The automaton of all pieces and the patterns behind them."""

    def __init__(self, base: dict[str, str], notices: list, chars_an_edit: int):
        import ahocorasick
        import regex

        self.base = base
        self.notices = [Notice.of(*n, chars_an_edit) for n in notices]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for at, piece in notice.pieces():
                pieces.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, users in pieces.items():
            self.automaton.add_word(piece, (len(piece), users))
        if pieces:
            self.automaton.make_automaton()
        self.seeded = bool(pieces)
        patterns = [regex.compile(n.pattern) for n in self.notices]

        @lru_cache(MAX_REMEMBERED)
        def verify(i: int, window: str) -> tuple[int, int, int] | None:
            """Place, end and edits of the best match within the bound."""
            found = patterns[i].search(window)
            if found is None or sum(found.fuzzy_counts) > self.notices[i].errors:
                return None
            return found.start() + 1, found.end(), sum(found.fuzzy_counts)

        self.verify = verify

    def exact(self, spaced: str) -> list[tuple[int, str]]:
        """Places of the base phrases, overlapping ones too, as character and label."""
        found = []
        for phrase, label in self.base.items():
            at = spaced.find(f" {phrase} ")
            while at >= 0:
                found.append((at + 1, label))
                at = spaced.find(f" {phrase} ", at + 1)
        return found

    def fuzzy(self, spaced: str) -> list[tuple[int, int, int, int]]:
        """``begin, end, edits, notice`` of the verified places."""
        windows = set()
        for last, (size, users) in self.automaton.iter(spaced) if self.seeded else ():
            for i, at in users:
                notice, begin = self.notices[i], last + 1 - size - at
                reach = notice.errors + 1
                windows.add((i, max(0, begin - reach), begin + len(notice.text) + reach))
        found = set()
        for i, low, high in windows:
            if (hit := self.verify(i, spaced[low:high])) is not None:
                found.add((low + hit[0], low + hit[1], hit[2], i))
        return sorted(found)

    def scan(self, text: str | None) -> tuple:
        spaced = normalised(text)
        exact, fuzzy = self.exact(spaced), self.fuzzy(spaced)
        places = [spaced.count(" ", 0, at) - 1 for at, _ in exact]
        base = {label for _, label in exact}
        matches = [
            {"label": self.notices[i].label, "word": spaced.count(" ", 0, begin) - 1, "edits": edits,
             "text": spaced[begin:end]}
            for begin, end, edits, i in fuzzy
        ]
        near = [1 - edits / len(self.notices[i].text) for _, _, edits, i in fuzzy]
        return (
            spaced.count(" ") - 1, len(exact), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {m["label"] for m in matches})),
            1.0 if exact else max(near, default=0.0), matches,
        )


def scan(
    documents: DataFrame, base: dict[str, str] = BASE, notices: list = NOTICES,
    chars_an_edit: int = CHARS_AN_EDIT,
) -> DataFrame:
    """``doc_id`` and the findings of every row, one row each.

    ``n_words`` words; ``n_base, first_word, last_word, base_labels`` from exact
    places of the ``base`` phrases (places are word numbers from 0, NULL without
    one); ``labels`` with those of the notices added; ``score`` 1 for an exact
    place, else the share of the best notice's characters that needed no edit,
    0 without any; ``matches`` the verified spans of the text's words.

    A missing or empty text has no words and no labels. Ties and repeated rows are
    judged alone, a NULL ``doc_id`` is kept, other columns are ignored, an empty
    table gives no rows. A text is read whole, in one task, whatever its length;
    nothing is shuffled.
    """
    rows = documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    base, notices = dict(base), list(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, chars_an_edit)
        for batch in batches:
            begin, size, found = 0, 0, []
            for i, text in enumerate(batch.column(1)):
                value = text.as_py()
                found.append(scanner.scan(value))
                size += len(value or "")
                if size >= SLICE_CHARS or i + 1 == batch.num_rows:
                    yield _rows(batch.column(0).slice(begin, len(found)), found)
                    begin, size, found = i + 1, 0, []

    return rows.mapInArrow(run, f"doc_id {kind}, {_SCAN}")


_TYPES = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
    pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("edits", pa.int32()), ("text", pa.string())])),
]
_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]


def _rows(ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), kind) for c, kind in zip(zip(*found), _TYPES)]
    return pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *_NAMES])


def op12_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("matches")
