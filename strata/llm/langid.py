"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read as its UTF-8 bytes in windows of ``WINDOW`` bytes, all of them;
the state starts anew in each, so windows of any text run side by side.
Two gated recurrent layers run over each window, one from either end; at every
byte the two states give a probability for each language, and a document's
probabilities are the means over all its bytes. The network is trained in numpy
by backpropagation through time on windows drawn from a bounded number of
documents of each language (``per_language``, ``SAMPLE_CHARS`` characters at a
place by hash of each, all languages in one scan), and is a few thousand numbers.

Defined cases: a text of any length is read whole, some windows at a time; of
languages with equal probability the first in order of name counts; null texts and texts without a letter are ``und`` with score 0;
training ignores null texts and null languages; without any training row every
text is ``und``; repeated rows are predicted each; null ids stay null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import fold, map_rows, text_bytes

UNKNOWN = "und"
WINDOW = 128
UNITS = 8
#: Training: documents of a language, characters of a document, windows of it.
PER_LANGUAGE, SAMPLE_CHARS = 300, 512
STEPS, BATCH, TRAIN_WINDOW, RATE = 160, 192, 64, 0.02
#: Windows that one worker runs side by side.
SIDE_BY_SIDE = 2048
#: Probability below which a document counts as in no language.
LEAST = 0.35
PREDICTIONS = "doc_id long, held_out boolean, lang_pred string, score double"

_LETTER = re.compile(r"[^\W\d_]")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=0))
    return x / x.sum(axis=0)


@dataclass
class Network:
    """Per direction: ``table`` (3 units, 256), the input part of the update
    gate, the reset gate and the candidate for each byte, ``state`` (3 units,
    units), and ``out`` (languages, units); one ``bias`` for the languages."""

    langs: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, langs: list[str], units: int = UNITS, seed: int = 4) -> Network:
        rng = np.random.default_rng(seed)
        weights = {"bias": np.zeros((len(langs), 1), np.float32)}
        for way in ("ahead", "back"):
            weights[f"table_{way}"] = rng.normal(0, 0.4, (3 * units, 256)).astype(np.float32)
            weights[f"state_{way}"] = rng.normal(0, units**-0.5, (3 * units, units)).astype(np.float32)
            weights[f"out_{way}"] = rng.normal(0, units**-0.5, (len(langs), units)).astype(np.float32)
        return cls(langs, weights)

    def layer(self, way: str, codes: np.ndarray, inside: np.ndarray, keep: bool):
        """States (steps, units, windows) of one direction; a state outside the
        text is zero. ``keep``: also what backpropagation needs."""
        table, state = self.weights[f"table_{way}"], self.weights[f"state_{way}"]
        steps, windows = codes.shape
        units = state.shape[1]
        h = np.zeros((units, windows), np.float32)
        states, kept = np.empty((steps, units, windows), np.float32), []
        for t in range(steps) if way == "ahead" else range(steps - 1, -1, -1):
            given, own = table[:, codes[t]], state @ h
            gates = sigmoid(given[: 2 * units] + own[: 2 * units])
            z, r = gates[:units], gates[units:]
            n = np.tanh(given[2 * units :] + r * own[2 * units :])
            if keep:
                kept.append((t, h, z, r, n, own[2 * units :]))
            h = (n + z * (h - n)) * inside[t]
            states[t] = h
        return states, kept

    def run(self, way: str, codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """What one direction adds to the languages' scores, (steps, languages,
        windows): ``layer`` in place, with the halves of the gates' logistic
        function, (1 + tanh(x / 2)) / 2, taken into the weights."""
        units = self.weights[f"state_{way}"].shape[1]
        half = np.repeat(np.array([0.5, 0.5, 1], np.float32), units)[:, None]
        table = np.ascontiguousarray(self.weights[f"table_{way}"] * half, np.float32)
        state = (self.weights[f"state_{way}"] * np.float32(0.5)).astype(np.float32)
        out = self.weights[f"out_{way}"]
        steps, windows = codes.shape
        given, own = (np.empty((3 * units, windows), np.float32) for _ in range(2))
        z, r, n = (given[k * units : (k + 1) * units] for k in range(3))
        h = np.zeros((units, windows), np.float32)
        scores = np.empty((steps, len(out), windows), np.float32)
        ends = not inside[-1].all()
        for t in range(steps) if way == "ahead" else range(steps - 1, -1, -1):
            np.take(table, codes[t], axis=1, out=given, mode="clip")
            np.matmul(state, h, out=own)
            gates = given[: 2 * units]
            gates += own[: 2 * units]
            np.tanh(gates, out=gates)
            gates += 1
            r *= own[2 * units :]
            n += r
            np.tanh(n, out=n)
            z *= 0.5
            h -= n
            h *= z
            h += n
            if ends:
                h *= inside[t]
            np.matmul(out, h, out=scores[t])
        return scores

    def probabilities(self, states: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """(languages, steps * windows) of the two directions' states."""
        w = self.weights
        flat = [s.transpose(1, 0, 2).reshape(s.shape[1], -1) for s in states]
        return softmax(w["out_ahead"] @ flat[0] + w["out_back"] @ flat[1] + w["bias"])

    def gradients(self, codes: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of all positions, by backpropagation
        through time; ``labels`` (windows,)."""
        w = self.weights
        made = {way: self.layer(way, codes, inside, True) for way in ("ahead", "back")}
        steps, windows = codes.shape
        p = self.probabilities((made["ahead"][0], made["back"][0])).reshape(-1, steps, windows)
        p[labels, :, np.arange(windows)] -= 1
        error = (p * inside / inside.sum()).reshape(len(p), -1)
        out = {"bias": error.sum(axis=1, keepdims=True)}
        for way, (states, kept) in made.items():
            units = states.shape[1]
            out[f"out_{way}"] = error @ states.transpose(1, 0, 2).reshape(units, -1).T
            above = (w[f"out_{way}"].T @ error).reshape(units, steps, windows)
            table, state = np.zeros_like(w[f"table_{way}"]), np.zeros_like(w[f"state_{way}"])
            carried = np.zeros((units, windows), np.float32)
            for t, h, z, r, n, own in reversed(kept):
                dh = (carried + above[:, t]) * inside[t]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * own * r * (1 - r)
                given = np.concatenate([dz, dr, dn])
                inner = np.concatenate([dz, dr, dn * r])
                state += inner @ h.T
                for row, values in enumerate(given):
                    table[row] += np.bincount(codes[t], values, 256)
                carried = dh * z + w[f"state_{way}"].T @ inner
            out[f"table_{way}"], out[f"state_{way}"] = table, state
        return out

    def train(self, texts: list[bytes], labels: np.ndarray, *, steps: int = STEPS, seed: int = 5) -> Network:
        """Adam over random windows, the languages in equal shares."""
        rng = np.random.default_rng(seed)
        by_lang = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            lang = rng.integers(0, len(self.langs), BATCH)
            rows = [by_lang[k][rng.integers(len(by_lang[k]))] for k in lang]
            codes = np.zeros((TRAIN_WINDOW, BATCH), np.uint8)
            inside = np.zeros((TRAIN_WINDOW, BATCH), np.float32)
            for i, row in enumerate(rows):
                at = rng.integers(0, max(1, len(texts[row]) - TRAIN_WINDOW + 1))
                part = np.frombuffer(texts[row][at : at + TRAIN_WINDOW], np.uint8)
                codes[: len(part), i], inside[: len(part), i] = part, 1
            rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
            for key, gradient in self.gradients(codes, inside, lang).items():
                first[key] += 0.1 * (gradient - first[key])
                second[key] += 0.01 * (gradient**2 - second[key])
                scale = np.sqrt(second[key] / (1 - 0.99**step)) + 1e-8
                self.weights[key] -= (rate * first[key] / (1 - 0.9**step) / scale).astype(np.float32)
        return self

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, languages): mean probability over all bytes of each."""
        lengths = np.diff(offsets)
        counts = -(-lengths // WINDOW)
        owner = np.repeat(np.arange(len(lengths)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = offsets[owner] + nth * WINDOW
        sizes = np.minimum(WINDOW, offsets[owner + 1] - starts)
        sums = np.zeros((len(owner), len(self.langs)))
        order = np.argsort(sizes, kind="stable")  # windows of like size together
        data = np.append(data, np.zeros(WINDOW, np.uint8))
        for at in range(0, len(order), SIDE_BY_SIDE):
            rows = order[at : at + SIDE_BY_SIDE]
            steps = int(sizes[rows[-1]])
            codes = data[np.arange(steps)[:, None] + starts[rows]].astype(np.intp)
            inside = (np.arange(steps)[:, None] < sizes[rows]).astype(np.float32)
            logits = self.run("ahead", codes, inside)
            logits += self.run("back", codes, inside)
            logits += self.weights["bias"]
            logits -= logits.max(axis=1, keepdims=True)
            np.exp(logits, out=logits)
            logits *= (inside / logits.sum(axis=1))[:, None]
            sums[rows] = logits.sum(axis=0).T
        out = np.zeros((len(lengths), len(self.langs)))
        some = counts > 0
        if some.any():
            out[some] = np.add.reduceat(sums, (np.cumsum(counts) - counts)[some])
        return out / np.maximum(lengths, 1)[:, None]


def first_of_each(spark: SparkSession, rows: DataFrame, n: int, counts: dict[str, int]) -> DataFrame:
    """The ``n`` rows of smallest hash of each language, all languages in one
    scan: about ``4 * n`` of a language get past the hash to be ordered."""
    if not counts:
        return rows.withColumn("h", F.lit(0).cast("long")).limit(0)
    least = [(lang, min(2**63 - 1, -(2**63) + 2**64 * 4 * n // total)) for lang, total in counts.items()]
    bounds = F.broadcast(spark.createDataFrame(least, "lang string, below long"))  # a row for each language
    rows = rows.withColumn("h", F.xxhash64("doc_id", "part")).join(bounds, "lang").where("h <= below")
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "part")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n).select("lang", "doc_id", "part", "h")


def fit(docs: DataFrame, *, per_language: int = PER_LANGUAGE, held_out: int = 0, folds: int = 5) -> Network:
    """Train on documents of the other folds: of each language the
    ``per_language`` first by a hash, a part of each at a place by that hash."""
    rows = docs.where(F.coalesce(fold("doc_id", folds) != held_out, F.lit(True))).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    rows = rows.select("lang", F.col("doc_id").cast("long"), "text")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each output of the network
    langs = sorted(counts)
    start = 1 + F.pmod(F.xxhash64("doc_id", F.length("text")), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS))
    part = F.substring(F.col("text"), start.cast("int"), F.lit(SAMPLE_CHARS)).alias("part")
    chosen = first_of_each(docs.sparkSession, rows.select("lang", "doc_id", part), per_language, counts)
    texts, labels = [], []
    for r in sorted(chosen.collect(), key=lambda r: (r.lang, r.h, r.doc_id is not None, r.doc_id or 0, r.part)):
        if _LETTER.search(r.part):
            texts.append(r.part.encode())
            labels.append(langs.index(r.lang))
    kept = sorted(set(labels))
    network = Network.fresh([langs[k] for k in kept])
    if kept:
        network.train(texts, np.searchsorted(kept, labels))
    return network


def has_letter(column: pa.Array) -> np.ndarray:
    return np.array([bool(text) and _LETTER.search(text) is not None for text in column.to_pylist()], bool)


def predict(network: Network, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text."""
    known = has_letter(column) & bool(network.langs)
    if not known.any():
        return [UNKNOWN] * len(column), np.zeros(len(column))
    means = network.documents(*text_bytes(column))
    means = means / np.maximum(means.sum(axis=1, keepdims=True), 1e-12)
    names = [network.langs[k] if ok else UNKNOWN for k, ok in zip(means.argmax(axis=1), known, strict=True)]
    return names, np.where(known, np.clip(means.max(axis=1), 0, 1), 0.0)


def identify(spark: SparkSession, docs: DataFrame, *, held_out: int = 0, folds: int = 5, **training) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every text."""
    network = fit(docs, held_out=held_out, folds=folds, **training)

    def run(batch: pa.RecordBatch) -> dict:
        names, scores = predict(network, batch.column(1))
        return {"doc_id": batch.column(0), "held_out": batch.column(2), "lang_pred": names, "score": scores}

    rows = docs.select(F.col("doc_id").cast("long"), "text", (fold("doc_id", folds) == held_out).alias("held_out"))
    return map_rows(rows, run, PREDICTIONS)


def keep_identified(docs: DataFrame, network: Network, *, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` whose text has a language with at least ``least``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict(network, batch.column(at))
            yield batch.filter(pa.array((np.array(names) != UNKNOWN) & (scores >= least)))

    return docs.mapInArrow(run, docs.schema)
