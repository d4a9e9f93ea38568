"""Benchmark decontamination by Wu-Manber search over words.

The test strings are all windows of consecutive item words. A block of words at the reading position that occurs in no
test string lets the search skip almost a whole window; one that ends test strings selects a bucket of them, narrowed
by how they begin, and those are compared word by word. Items go through the driver in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, functions as F

from fleetworks.llm.frames import append, hidden, named, shown
from fleetworks.llm.words import lettered_words
from fleetworks.session import scratch_dir, settle

WINDOW = 10
#: Item words that are searched for at once, and held by the driver and by a task.
BLOCK_WORDS = 100_000
_FOUND = "spans array<struct<a:bigint,b:bigint>>, items array<string>"


class WuManber:
    """Search for test strings that all have the same number of words."""

    def __init__(self, strings: dict[tuple[bytes, ...], set[str]], length: int):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict] = {}
        for words, items in strings.items():
            for end in range(self.block, length + 1):
                block = words[end - self.block:end]
                self.shift[block] = min(length - end, self.shift.get(block, self.far))
            self.buckets.setdefault(words[-self.block:], {}).setdefault(words[:self.block], []).append((words, items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Start and items of every occurrence."""
        length, size, far, shift, end = self.length, self.block, self.far, self.shift, self.length
        while end <= len(words):
            block = tuple(words[end - size:end])
            skip = shift.get(block, far)
            if skip:
                end += skip
                continue
            start = end - length
            for candidate, items in self.buckets[block].get(tuple(words[start:start + size]), ()):
                if list(candidate) == words[start:end]:
                    yield start, items
            end += 1


class Search:
    """All windows of a block of items, grouped by their length."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        strings: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for name, words in items:
            length = min(window, len(words))
            for at in range(len(words) - length + 1 if length else 0):
                strings.setdefault(length, {}).setdefault(tuple(words[at:at + length]), set()).add(name)
        self.searches = [WuManber(group, length) for length, group in sorted(strings.items())]

    def read(self, text: str | None) -> tuple[int, list[dict], list[str]]:
        """Number of words, hit stretches as merged [a, b) and names of items that occur."""
        words = lettered_words(text)
        names: set[str] = set()
        hits: list[tuple[int, int]] = []
        for search in self.searches:
            for start, items in search.find(words):
                names |= items
                hits.append((start, start + search.length))
        spans: list[dict] = []
        for a, b in sorted(hits):
            if spans and a <= spans[-1]["b"]:
                spans[-1]["b"] = max(b, spans[-1]["b"])
            else:
                spans.append({"a": a, "b": b})
        return len(words), spans, sorted(names)


def _blocks(items: DataFrame, key: str, text: str, window: int, limit: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most about ``limit`` words; a longer one is cut into parts that overlap by a window."""
    block, held = [], 0
    for row in items.select(named(key).cast("string").alias("k"), named(text).alias("t")).toLocalIterator():
        words = lettered_words(row["t"])
        at = 0
        while words and (at == 0 or at + window - 1 < len(words)):
            part = words[at:at + limit + window - 1]
            if held and held + len(part) > limit:
                yield block
                block, held = [], 0
            block.append((row["k"] or "", part))
            held += len(part)
            at += limit
    yield block


def _searched(rows: DataFrame, text: str, block: list, window: int, keep: list[str]) -> DataFrame:
    """``rows`` with n_words, and spans and items of what occurs of one block."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def make():
        search = Search(shared.value, window)
        return lambda texts: list(zip(*map(search.read, texts)))

    return append(rows, text, f"n_words bigint, {_FOUND}", make, keep)


def mark(docs: DataFrame, items: DataFrame, text: str = "text", keep=None, item_key: str = "item_id",
         item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, ``items`` (names, sorted as strings), ``spans`` and ``contaminated``.

    A word is hit inside any occurrence of a window of ``window`` consecutive item words; an item of fewer words, but
    not none, is one window. ``spans`` are the hit stretches, words from 0, end excluded. Null and empty texts have no
    words and are clean; items without words match nothing. An item without id counts under the empty name. Repeated
    rows and items change nothing else; without items all documents are clean. Clashing columns are replaced.
    """
    added = ["n_words", "n_hit", "n_items", "items", "spans", "contaminated"]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    rows, names = hidden(docs.select(*map(named, kept), *([] if text in kept else [named(text)])))
    blocks = _blocks(items, item_key, item_text, window, block_words)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        marked = _searched(rows, names[text], block, window, [names[c] for c in kept])
    else:
        # the texts are written once, with numbers, and every block writes no more than what it finds
        rows = settle(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered-texts")
        path, n = scratch_dir(docs.sparkSession, "hits"), 0
        while block is not None:
            _searched(rows, names[text], block, window, ["_row"]).where(F.size("spans") > 0).drop("n_words").write.parquet(f"{path}/block={n}")
            block, following, n = following, next(blocks, None), n + 1
        hits = docs.sparkSession.read.schema(f"_row bigint, {_FOUND}, block int").parquet(path).groupBy("_row").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        counted = append(rows, names[text], "n_words bigint", lambda: lambda texts: [[len(lettered_words(t)) for t in texts]],
                         [*[names[c] for c in kept], "_row"])
        nothing = {c: F.expr(f"cast(array() as {kind})") for c, kind in (part.split(" ") for part in _FOUND.split(", "))}
        marked = counted.join(hits, "_row", "left").withColumns({c: F.coalesce(c, empty) for c, empty in nothing.items()})
    # stretches of different blocks may overlap
    hit = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0).cast("bigint"), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"),
                              F.greatest(s["end"], x["b"]).alias("end")))["n"]
    return marked.withColumn("items", F.array_sort("items")).select(
        *[F.col(names[c]).alias(c) for c in kept], "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), "items", "spans",
        (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with their own columns."""
    inside, names = hidden(docs)
    return shown(mark(inside, items, names[text], **options).where(~F.col("contaminated")), names)
