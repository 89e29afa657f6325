"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of all benchmark items go into one automaton over word numbers; each document is
normalised, turned into word numbers and scanned once.  Matches are word ranges, which map back
to character offsets of the original text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.text import map_texts
from panelcast.sources.sinks import materialize

# The words of texts and items, after A-Z is lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10

# as bytes: A-Z to a-z, every other byte outside 0-9, a-z and 0x80-0xFF to a space
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

# One automaton takes about this many bytes of item text; more text makes more automata and scans.
AUTOMATON_BYTES = 8 << 20


def folded_words(text: str | None) -> list[bytes]:
    """Normalised words in UTF-8; null has none."""
    return [] if text is None else text.encode().translate(_FOLD).split()


@dataclass
class Windows:
    """An automaton over the word numbers of benchmark items, built where it is first used."""

    items: list[tuple]  # (item_id, text)
    window: int = WINDOW
    _built: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"items": self.items, "window": self.window, "_built": None}

    def build(self) -> tuple:
        import ahocorasick

        if self._built is None:
            numbers: dict[bytes, int] = {}
            owners: dict[tuple[int, ...], set] = {}
            for item_id, text in self.items:
                words = [numbers.setdefault(w, len(numbers) + 1) for w in folded_words(text)]
                width = min(self.window, len(words))
                for i in range(len(words) - width + 1 if width else 0):
                    owners.setdefault(tuple(words[i : i + width]), set()).add(item_id)
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for key, ids in owners.items():
                automaton.add_word(key, (len(key), ids))
            automaton.make_automaton()
            self._built = numbers, automaton if owners else None
        return self._built

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word ranges [start, end) covered by windows, merged, and the items they belong to."""
        numbers, automaton = self.build()
        if automaton is None or not words:
            return [], set()
        get = numbers.get
        spans: list[list[int]] = []
        items: set = set()
        for end, (width, ids) in automaton.iter(tuple([get(w, 0) for w in words])):
            items |= ids
            start = end + 1 - width
            while spans and start <= spans[-1][1]:
                start = min(start, spans.pop()[0])
            spans.append([start, end + 1])
        return [tuple(s) for s in spans], items


_SPAN = "struct<first_word: long, last_word: long, start: long, end: long>"


def find_windows(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW) -> DataFrame:
    """``keep`` and ``n_words``, ``spans``, ``item_ids`` (as text, sorted) of every row of ``docs``.

    A span is a range of words [``first_word``, ``last_word``) and its characters [``start``,
    ``end``) in the original text, covered by windows of ``window`` consecutive
    item words; an item of fewer words, but not none, is one window.  Null and empty texts have no
    words and no spans, null or empty items no windows.  Of items without an id the spans are
    reported but no id.  Equal ids and repeated rows are scanned one by one.

    The automaton travels to the executors.  Items are taken in groups of at most
    ``AUTOMATON_BYTES``, whose size is summed first; a larger benchmark takes one scan per group,
    and the groups' findings are put together row by row.
    """
    rows = docs.select(*keep, F.col("text").alias("__scan"))
    groups = _groups(benchmark.select("item_id", "text"))
    found = None
    for i, group in enumerate(groups):
        items = [(r.item_id, r.text) for r in group.toLocalIterator()]
        carried = list(keep) if found is None else [c for c in found.columns if c != "__scan"]
        last = i == len(groups) - 1
        source = rows if found is None else found
        schema = f"words{i} long, spans{i} array<{_SPAN}>, ids{i} array<string>"
        extra = [] if last else ["__scan"]
        found = map_texts(source, "__scan", carried + extra, schema, _scanner(Windows(items, window)))
        if not last:
            found = materialize(found, "decontaminate")
    n = len(groups)
    spans = F.array_sort(F.concat(*[F.col(f"spans{i}") for i in range(n)]))
    ids = F.array_sort(F.array_distinct(F.concat(*[F.col(f"ids{i}") for i in range(n)])))
    return found.select(*keep, F.col("words0").alias("n_words"), (F.col("spans0") if n == 1 else _merged(spans)).alias("spans"), ids.alias("item_ids"))


def _groups(items: DataFrame) -> list[DataFrame]:
    """The items in groups of bounded bytes, dealt by a hash of the row; equal rows count once."""
    items = items.distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // AUTOMATON_BYTES) or 1
    if n == 1:
        return [items]
    # twice as many groups as needed, so that an uneven deal stays within the bound
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * n)) == i) for i in range(2 * n)]


def _merged(spans: Column) -> Column:
    """Ranges of an ordered array that touch or overlap as one."""
    last = lambda acc: F.element_at(acc, -1)

    def add(acc: Column, s: Column) -> Column:
        joined = F.struct(
            last(acc)["first_word"].alias("first_word"), F.greatest(last(acc)["last_word"], s["last_word"]).alias("last_word"),
            last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], s["end"]).alias("end"),
        )
        touches = (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["last_word"] >= s["first_word"])
        return F.when(touches, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, F.expr(f"CAST(array() AS array<{_SPAN}>)"), add)


def _scanner(windows: Windows):
    lower = {c: c + 32 for c in range(65, 91)}

    def scan(texts: list) -> list[list]:
        n_words, spans, ids = [], [], []
        for text in texts:
            words = folded_words(text)
            n_words.append(len(words))
            found, items = windows.scan(words)
            ids.append(sorted(str(i) for i in items if i is not None))
            if found:
                # only texts with a match pay for the offsets of their words
                at = np.array([m.span() for m in WORD.finditer(text.translate(lower))])
                spans.append([
                    {"first_word": a, "last_word": b, "start": int(at[a, 0]), "end": int(at[b - 1, 1])} for a, b in found
                ])
            else:
                spans.append([])
        return [n_words, spans, ids]

    return scan


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The report of ``op10``: per document its words, words hit, and items found."""
    found = find_windows(docs, benchmark, ("doc_id",), window)
    zero = F.lit(0).cast("long")
    n_hit = F.aggregate("spans", zero, lambda n, s: n + s["last_word"] - s["first_word"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
