"""License scan: base phrases, and short notices with a bounded number of errors.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased. A base phrase is found where its words stand in a row. A notice
is searched in the words joined by single spaces: it is cut into one piece
more than the errors allowed (one for every ``PER_ERROR`` characters), so a
place with that few errors holds one piece unchanged; an automaton of all
pieces finds those, and the regex library's bounded-error matching verifies
the joined places and reports the span and the errors. Matches of one notice do
not overlap; what is left of a place on both sides of a match is searched on.

A label's similarity is 1 minus errors over the notice's length, 1 for a base
phrase; the score is the best of them, 0 without a label. Of equally good
matches of a notice in one place the first is taken first. Null and empty texts have no words. Rows
are independent, so repeated rows and ties need no care. Extra columns are not
read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import released, ship, table, text_slices
from .decontaminate import normal
from .textcore import Words

# Base phrases and labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Short notices, as their words, and labels.
NOTICES = (
    ("under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("under the apache license version 2", "apache-2"),
    ("attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution", "cc-by"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2", "mpl-2"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("released into the public domain", "public-domain"),
    ("all rights reserved", "all-rights-reserved"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("provided as is without any express or implied warranty", "zlib"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("boost software license version 1", "bsl-1"),
    ("eclipse public license version 2", "epl-2"),
    ("common development and distribution license", "cddl"),
    ("european union public licence", "eupl"),
    ("the artistic license 2 0", "artistic-2"),
    ("academic free license version 3", "afl-3"),
    ("microsoft public license", "ms-pl"),
    ("sil open font license version 1", "ofl"),
    ("gnu free documentation license", "gfdl"),
    ("attribution sharealike", "cc-by-sa"),
    ("attribution noderivatives", "cc-by-nd"),
    ("creative commons zero", "cc0"),
    ("cc0 1 0 universal", "cc0"),
    ("open database license", "odbl"),
    ("server side public license", "sspl"),
    ("business source license", "busl"),
)
#: Characters of a notice for each error allowed.
PER_ERROR = 10


class Notices:
    """Automaton of the pieces and a bounded-error pattern of each notice."""

    def __init__(self, notices=NOTICES, per_error: int = PER_ERROR):
        self.notices = [(text, label, len(text) // per_error) for text, label in notices]
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(text)}){{e<={budget}}}")
                         for text, _, budget in self.notices]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (text, _, budget) in enumerate(self.notices):
            cut = [len(text) * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cut, cut[1:]):
                pieces.setdefault(text[a:b], []).append((n, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def search(self, joined: str, bounds: list[int]):
        """(text, notice, first, end, errors) of the matches in each joined place: the first exact
        or else the best one, then those in what is left of the place before and after it."""
        places: dict[tuple[int, int], list[list[int]]] = {}
        text = 0
        for end, (size, where) in self.automaton.iter(joined):
            while end >= bounds[text + 1]:
                text += 1
            for n, offset in where:
                notice, _, budget = self.notices[n]
                start = end + 1 - size - offset
                lo, hi = max(bounds[text], start - budget), min(bounds[text + 1], start + len(notice) + budget)
                if hi - lo < len(notice) - budget:
                    continue
                own = places.setdefault((text, n), [])
                if own and lo <= own[-1][1] and own[-1][0] <= hi:
                    own[-1] = [min(lo, own[-1][0]), max(hi, own[-1][1])]
                else:
                    own.append([lo, hi])
        for (text, n), spans in places.items():
            exact, _, budget = self.notices[n]
            left = list(spans)
            while left:
                lo, hi = left.pop()
                if hi - lo < len(exact) - budget:
                    continue
                if (at := joined.find(exact, lo, hi)) >= 0:
                    first, end, errors = at, at + len(exact), 0
                elif m := self.patterns[n].search(joined, lo, hi):
                    first, end, errors = m.start(), m.end(), sum(m.fuzzy_counts)
                else:
                    continue
                yield text, n, first, end, errors
                left += [[lo, first], [end, hi]]


def base_places(words: Words, phrase: str) -> np.ndarray:
    """Numbers (in the batch) of the words at which a phrase starts within one text."""
    parts = Words([phrase.encode()], True, np.ones(256, dtype=bool) & (np.arange(256) != 32))
    own = parts.hash
    k, h = len(own), words.hash
    if len(h) < k:
        return np.zeros(0, dtype=np.int64)
    hit = words.text[k - 1:] == words.text[:len(h) - k + 1]
    for j in range(k):
        hit &= h[j:len(h) - k + 1 + j] == own[j]
    at = np.flatnonzero(hit)
    exact = phrase.encode().split()
    return np.array([i for i in at if all(words.word(i + j) == x for j, x in enumerate(exact))], dtype=np.int64)


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("matches", pa.list_(pa.struct([("label", pa.string()), ("first_byte", pa.int32()), ("end_byte", pa.int32()),
                                    ("errors", pa.int32())])))])
RESULT_SQL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, "
              "matches array<struct<label: string, first_byte: int, end_byte: int, errors: int>>")


@released
def _scan(batches):
    notices = Notices()
    for batch in batches:
        for lo, hi, texts in text_slices(batch, 1):
            joined, first, words, place = normal(texts)
            n, count = hi - lo, words.n
            where: list[list[int]] = [[] for _ in range(n)]
            base: list[set[str]] = [set() for _ in range(n)]
            for phrase, label in BASE:
                for i in base_places(words, phrase):
                    t = int(words.text[i])
                    where[t].append(int(i - words.count_before[t]))
                    base[t].add(label)
            best: list[dict[str, float]] = [dict.fromkeys(x, 1.0) for x in base]
            found: list[list[dict]] = [[] for _ in range(n)]
            # one byte is one character, as in the notices
            for t, k, a, b, errors in notices.search(joined.decode("latin-1"), first.tolist()):
                text, label, _ = notices.notices[k]
                best[t][label] = max(best[t].get(label, 0.0), 1 - errors / len(text))
                x = int(np.searchsorted(place, a, "right")) - 1
                y = int(np.searchsorted(place, b - 1, "right")) - 1
                begin = words.first_byte[t]
                found[t].append({"label": label, "first_byte": int(words.start[x] - begin),
                                 "end_byte": int(words.end[y] - begin), "errors": errors})
            columns = [
                batch.column(0).slice(lo, n).cast(pa.int64()), pa.array(count), pa.array([len(x) for x in where], pa.int64()),
                pa.array([min(x, default=None) for x in where], pa.int64()),
                pa.array([max(x, default=None) for x in where], pa.int64()),
                pa.array([",".join(sorted(x)) for x in base]), pa.array([",".join(sorted(x)) for x in best]),
                pa.array([max(x.values(), default=0.0) for x in best], pa.float64()),
                pa.array([sorted(x, key=lambda m: (m["first_byte"], m["label"])) for x in found], RESULT.field("matches").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=RESULT)


def scan_licenses(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row for each document: base places, labels, score and matched spans (bytes of the text)."""
    ship(spark)
    return docs.select("doc_id", "text").mapInArrow(_scan, RESULT_SQL)


def op2_fuzzy_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark, table(spark, sf_dir, "documents")).drop("matches")
