"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy.

A text is read in windows of bytes, whole and in order. One network reads each window forwards, one backwards; both
have a gate that decides how much of their state a byte replaces. Each position gets a distribution over the learned
languages, and a document's is the mean over its positions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks.llm.frames import append, named

UNDETERMINED = "und"
#: Bounds of the learning sample: rows of a language, pieces of a row, bytes of a piece, languages.
SAMPLE_ROWS, SAMPLE_PIECES, WINDOW, MAX_LANGUAGES = 400, 6, 64, 200
#: Share of the labelled rows whose score may lie lower than what is usual.
UNUSUAL = 0.002
#: Size of either state, steps of learning at least, pieces a step, rate of learning.
STATE, STEPS, BATCH, RATE = 8, 240, 256, 0.02
#: Windows read at once by one task.
LANES = 4096
#: The pass over all labelled rows: windows a step, windows shuffled at once, rate of learning.
PASS_BATCH, PASS_SHUFFLED, PASS_RATE = 1024, 8192, 0.001


def _gate(u: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * u / (1 + np.abs(u))


def _squash(u: np.ndarray) -> np.ndarray:
    return u / (1 + np.abs(u))


@dataclass
class Direction:
    """One reading direction: what each byte adds to gate and candidate, and how the state feeds back into both."""

    byte: np.ndarray  # (2 * state, 256)
    gate: np.ndarray  # (state, state)
    candidate: np.ndarray  # (state, state)

    def step(self, state: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(state)
        a = np.take(self.byte, x, axis=1, mode="clip")
        gu = self.gate @ state
        gu += a[:n]
        g = _gate(gu)
        held = g * state
        cu = self.candidate @ held
        cu += a[n:]
        c = _squash(cu)
        return g, held, c, state + g * (c - state)


class Adam:
    """Steps of learning, each scaled by what the gradients were before."""

    def __init__(self, parts: list[np.ndarray]):
        self.parts, self.n = parts, 0
        self.mean, self.square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]

    def step(self, grads: list[np.ndarray], rate: float) -> None:
        self.n += 1
        for p, g, m, s in zip(self.parts, grads, self.mean, self.square):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= rate * (m / (1 - 0.9 ** self.n)) / (np.sqrt(s / (1 - 0.99 ** self.n)) + 1e-7)


class Network:
    """Both directions and the layer that turns their states into languages."""

    def __init__(self, languages: list[str], parts: list[np.ndarray]):
        self.languages, self.parts = languages, parts
        self.ahead, self.back = Direction(*parts[0:3]), Direction(*parts[3:6])
        self.out, self.bias = parts[6], parts[7]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        one = lambda *shape, scale: rng.normal(scale=scale, size=shape).astype(np.float32)
        parts = []
        for _ in range(2):
            parts += [one(2 * STATE, 256, scale=0.5), one(STATE, STATE, scale=0.3), one(STATE, STATE, scale=0.3)]
        return cls(languages, [*parts, one(len(languages), 2 * STATE, scale=0.3),
                               np.zeros((len(languages), 1), np.float32)])

    def positions(self, x: np.ndarray):
        """Yields (place, probabilities) for bytes x (places, lanes), from the last place to the first."""
        places, lanes = x.shape
        state = np.zeros((STATE, lanes), np.float32)
        ahead = []
        for t in range(places):
            state = self.ahead.step(state, x[t])[3]
            ahead.append(state)
        state = np.zeros((STATE, lanes), np.float32)
        to_ahead, to_back = self.out[:, :STATE], self.out[:, STATE:]
        for t in reversed(range(places)):
            state = self.back.step(state, x[t])[3]
            scores = to_ahead @ ahead[t]
            scores += to_back @ state
            scores += self.bias
            scores -= scores.max(0)
            np.exp(scores, out=scores)
            scores /= scores.sum(0)
            yield t, scores

    def gradients(self, x: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None) -> tuple[list[np.ndarray], float]:
        """Backpropagation through time of the mean cross-entropy over all positions; ``weight`` weighs the lanes' gradients."""
        places, lanes = x.shape
        runs = []
        for direction, order in ((self.ahead, range(places)), (self.back, range(places - 1, -1, -1))):
            state, kept = np.zeros((STATE, lanes), np.float32), {}
            for t in order:
                g, held, c, after = direction.step(state, x[t])
                kept[t] = (state, g, held, c, after)
                state = after
            runs.append((direction, order, kept))
        grads = [np.zeros_like(p) for p in self.parts]
        loss, slopes = 0.0, [{}, {}]
        for t in range(places):
            both = np.concatenate([runs[0][2][t][4], runs[1][2][t][4]])
            scores = self.out @ both + self.bias
            scores -= scores.max(0)
            p = np.exp(scores)
            p /= p.sum(0)
            loss -= float(np.log(p[target, np.arange(lanes)] + 1e-9).mean()) / places
            p[target, np.arange(lanes)] -= 1
            p /= places * lanes
            if weight is not None:
                p *= weight
            grads[6] += p @ both.T
            grads[7] += p.sum(1, keepdims=True)
            d = self.out.T @ p
            slopes[0][t], slopes[1][t] = d[:STATE], d[STATE:]
        for i, (direction, order, kept) in enumerate(runs):
            at, carry = 3 * i, np.zeros((STATE, lanes), np.float32)
            by_byte, slopes_of = np.zeros((256, 2 * STATE), np.float32), np.empty((2 * STATE, places, lanes), np.float32)
            for t in reversed(order):
                state, g, held, c, _ = kept[t]
                d = slopes[i][t] + carry
                cu = d * g * (1 - np.abs(c)) ** 2
                d_held = direction.candidate.T @ cu
                gu = (d * (c - state) + d_held * state) * 0.5 * (1 - np.abs(2 * g - 1)) ** 2
                carry = d * (1 - g) + d_held * g + direction.gate.T @ gu
                grads[at + 1] += gu @ state.T
                grads[at + 2] += cu @ held.T
                if weight is None:
                    np.add.at(by_byte, x[t], np.concatenate([gu, cu]).T)
                else:
                    slopes_of[:STATE, t], slopes_of[STATE:, t] = gu, cu
            if weight is not None:  # all places at once, which is much faster for many lanes
                flat = x.ravel()
                by_byte = np.stack([np.bincount(flat, s.ravel(), 256) for s in slopes_of], axis=1)
            grads[at] += by_byte.T
        return grads, loss

    def train(self, x: np.ndarray, target: np.ndarray, seed: int = 11) -> None:
        """Adam over shuffled pieces x (pieces, WINDOW)."""
        rng = np.random.default_rng(seed)
        adam = Adam(self.parts)
        passes = -(-STEPS // -(-len(x) // BATCH))
        for done in range(passes):
            rate = RATE * (1 - done / passes)
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                pick = order[at:at + BATCH]
                adam.step(self.gradients(np.ascontiguousarray(x[pick].T), target[pick])[0], rate)

    def train_once(self, pieces: Iterable[tuple[bytes, int]], weights: np.ndarray, seed: int = 13) -> int:
        """One pass over windows of WINDOW bytes with their language, as they come, weighed by language. Returns their number."""
        rng, adam, seen = np.random.default_rng(seed), Adam(self.parts), 0
        pieces = iter(pieces)
        while held := list(islice(pieces, PASS_SHUFFLED)):
            x = np.frombuffer(b"".join(p for p, _ in held), np.uint8).reshape(-1, WINDOW)
            target = np.array([c for _, c in held])
            order = rng.permutation(len(x))
            for at in range(0, len(x), PASS_BATCH):
                pick = order[at:at + PASS_BATCH]
                adam.step(self.gradients(np.ascontiguousarray(x[pick].T), target[pick], weights[target[pick]])[0], PASS_RATE)
            seen += len(x)
        return seen

    def read(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and pooled probability of each whole text; undetermined and 0 where it has no letter."""
        raw = [t.encode() if t and any(map(str.isalpha, t)) else b"" for t in texts]
        counts = np.array([-(-len(b) // WINDOW) for b in raw])
        pooled = np.zeros((len(raw), len(self.languages)))
        owner = np.repeat(np.arange(len(raw)), counts)
        cells = np.frombuffer(b"".join(b.ljust(n * WINDOW, b" ") for b, n in zip(raw, counts)), np.uint8)
        cells = cells.reshape(-1, WINDOW)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        length = np.minimum(WINDOW, np.array([len(b) for b in raw], np.int64)[owner] - place * WINDOW)
        for at in range(0, len(cells), LANES):
            x = np.ascontiguousarray(cells[at:at + LANES].T)
            total = np.zeros((len(self.languages), x.shape[1]), np.float32)
            ragged = int(length[at:at + LANES].min())
            for t, p in self.positions(x):
                total += p if t < ragged else p * (length[at:at + LANES] > t)
            np.add.at(pooled, owner[at:at + LANES], total.T)
        pooled /= np.maximum([[len(b)] for b in raw], 1)
        best = pooled.argmax(1) if len(self.languages) else []
        return ([self.languages[b] if len(t) else UNDETERMINED for b, t in zip(best, raw)],
                [float(min(1.0, pooled[i, b])) if raw[i] else 0.0 for i, b in enumerate(best)])


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the key as text, modulo 3, is 1. A null key counts as empty text."""
    return F.crc32(F.coalesce(named(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _labelled(docs: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(lang, k, body, h): the rows that may be learned from, with a hash of key and text in [0, 1)."""
    return docs.where(~held_out(key) & named(label).isNotNull() & named(text).rlike(r"\p{L}")).select(
        named(label).cast("string").alias("lang"), named(key).alias("k"), named(text).alias("body"),
        (F.shiftrightunsigned(F.xxhash64(named(key), named(text)), 11) / F.lit(2.0 ** 53)).alias("h"))


def different_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> dict[str, int]:
    """About how many different rows each of the ``MAX_LANGUAGES`` most frequent languages has to learn from."""
    counts = _labelled(docs, key, text, label).groupBy("lang").agg(
        F.count("*").alias("n"), F.approx_count_distinct("h").alias("different")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    return {r["lang"]: max(1, r["different"]) for r in counts.collect()}


def _below(different: dict[str, int], rows: int) -> Column:
    """The hash below which about ``rows`` rows of a language lie; NULL for languages that are not learned."""
    limits = {lang: min(1.0, rows / n) for lang, n in different.items()} or {"": 0.0}
    return F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("lang")]


def learning_sample(docs: DataFrame, key: str, text: str, label: str, different: dict[str, int] | None = None) -> DataFrame:
    """(lang, place, k, pieces): pieces of at most ``SAMPLE_ROWS`` rows of each language, spread over their texts.

    The rows with the smallest hashes of key and text are taken, equal ones once. The languages' estimated numbers of
    different hashes first tell how small one must be, so that only a few times as many rows are ranked, however many
    there are and however often a key or row repeats. Held-out rows, null labels and texts without a letter are left
    out, and languages beyond the ``MAX_LANGUAGES`` most frequent.
    """
    different = different_rows(docs, key, text, label) if different is None else different
    length = F.length("body")
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_PIECES - 1)),
        lambda i: F.substring("body", (1 + i * F.greatest(length - WINDOW, F.lit(0)) / (SAMPLE_PIECES - 1)).cast("int"),
                              F.lit(WINDOW)))
    # four times the rows wanted, so neither the estimate's 5 % nor chance leaves too few below the limit
    cut = _labelled(docs, key, text, label).where(F.col("h") <= _below(different, 4 * SAMPLE_ROWS)).select(
        "lang", "h", "k", F.array_distinct(pieces).alias("pieces")).distinct()
    by_hash = Window.partitionBy("lang").orderBy("h", "k", "pieces")
    return cut.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= SAMPLE_ROWS).drop("h")


def usual_scores(scored: DataFrame, network: Network, key: str = "doc_id", text: str = "text", label: str = "lang") -> dict[str, float]:
    """Per predicted language the score that all but ``UNUSUAL`` of the labelled rows reach that are predicted so.

    ``scored`` comes from ``identify``. All rows with a learned label count but held-out ones, equal rows once, right or
    wrong. Pooled scores fall as languages are added, so they have to be taken anew with every network.
    """
    rows = scored.where(~held_out(key) & named(label).cast("string").isin(*network.languages) & named(text).rlike(r"\p{L}")).select(
        "lang_pred", "score", named(label).cast("string").alias("lang"), F.xxhash64(named(key), named(text)).alias("h"))
    found = rows.distinct().groupBy("lang_pred").agg(F.percentile_approx("score", UNUSUAL, 10_000).alias("least")).collect()
    return {r["lang_pred"]: r["least"] for r in found}  # a row per language


def _windows(texts: Iterable[str], classes: Iterable[int]) -> Iterable[tuple[bytes, int]]:
    for text, c in zip(texts, classes):
        raw = text.encode()
        for at in range(0, len(raw), WINDOW):
            yield raw[at:at + WINDOW].ljust(WINDOW), c


def learn_all(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text", label: str = "lang",
              different: dict[str, int] | None = None) -> Network:
    """The network after a pass over every byte of every labelled row of its languages.

    Each task goes on from the given network over its own rows. The results are averaged by the windows behind them, one
    sum per parameter, so the driver gets a single network however many tasks there are. A frequent language weighs no more
    than a rare one. Held-out rows are left out.
    """
    languages, parts = network.languages, network.parts
    if len(languages) < 2:
        return network
    different = different_rows(docs, key, text, label) if different is None else different
    counts = np.array([different[lang] for lang in languages], np.float64)
    weights = (counts.sum() / len(counts) / counts).astype(np.float32)
    place = {lang: i for i, lang in enumerate(languages)}
    rows = _labelled(docs, key, text, label).where(F.col("lang").isin(*languages)).select("lang", "body")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        local = Network(languages, [p.copy() for p in parts])
        seen = local.train_once(
            (piece for batch in batches
             for piece in _windows((v.as_py() for v in batch.column(1)), (place[v.as_py()] for v in batch.column(0)))), weights)
        if seen:
            values = np.concatenate([p.ravel() for p in local.parts]).astype(np.float64)
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(np.arange(len(values)), pa.int64()), "total": values * seen, "windows": np.full(len(values), float(seen))})

    learned = rows.mapInArrow(run, "at long, total double, windows double").groupBy("at").agg(
        (F.sum("total") / F.sum("windows")).alias("value")).orderBy("at").collect()  # a row per parameter
    if not learned:
        return network
    values, out, at = np.array([r["value"] for r in learned], np.float32), [], 0
    for p in parts:
        out.append(values[at:at + p.size].reshape(p.shape))
        at += p.size
    return Network(languages, out)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
        different: dict[str, int] | None = None) -> Network:
    """A network fitted to the learning sample. Without any labelled row it knows no language."""
    # at most MAX_LANGUAGES * SAMPLE_ROWS * SAMPLE_PIECES pieces of WINDOW characters
    rows = learning_sample(docs, key, text, label, different).orderBy("lang", "place").select("lang", "pieces").collect()
    languages = sorted({r["lang"] for r in rows})
    pieces = [(p.encode()[:WINDOW].ljust(WINDOW), languages.index(r["lang"])) for r in rows for p in r["pieces"]]
    network = Network.fresh(languages)
    if len(languages) > 1:
        x = np.frombuffer(b"".join(p for p, _ in pieces), np.uint8).reshape(-1, WINDOW)
        network.train(x, np.array([c for _, c in pieces]))
    return network


def identify(docs: DataFrame, network: Network, text: str = "text", keep=None) -> DataFrame:
    """``lang_pred`` and ``score`` of every whole text.

    A null text, an empty one and one without a letter are ``und`` with score 0, and so is every text if the network
    knows no language. Rows are never dropped; repeated rows get the same answer; clashing columns are replaced.
    """
    languages, parts = network.languages, network.parts

    def make():
        if not languages:
            return lambda texts: ([UNDETERMINED] * len(texts), [0.0] * len(texts))
        return Network(languages, parts).read

    return append(docs, text, "lang_pred string, score double", make, keep)
