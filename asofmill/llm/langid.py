"""Language ID by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on windows of a bounded sample
of labelled texts, then sent to the tasks. There it runs over every byte of every text, in
windows of ``WINDOW`` bytes, labels each position and averages the positions' probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship
from .common import joined_bytes, quoted, split_text_batches, within_share

#: Bytes that the network reads at once, hidden units of each direction.
WINDOW, HIDDEN = 64, 8
#: The bounded sample: texts for each language, windows from each text, and languages beyond which each gives fewer texts.
PER_LANGUAGE, PER_TEXT, LANGUAGES = 400, 6, 256
UNDETERMINED = "und"


class ByteGru:
    """Two gated recurrent layers, one for each direction, and a softmax at every position.

    z = s(xz + h Uz), r = s(xr + h Ur), c = tanh(xc + (r * h) Uc), h' = h + z * (c - h); the
    byte's input is a row of a table, so the biases are in it. All gates keep arrays (rows, hidden).
    """

    def __init__(self, labels: int, hidden: int = HIDDEN, seed: int = 7):
        random = np.random.default_rng(seed)
        draw = lambda *shape: (random.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = {f"{d}{k}": draw(256, hidden) for d in "fb" for k in ("z", "r", "c")}
        self.p |= {f"{d}U{k}": draw(hidden, hidden) for d in "fb" for k in ("z", "r", "c")}
        self.p |= {f"{d}o": draw(hidden, labels) for d in "fb"} | {"bias": np.zeros(labels, np.float32)}

    def _layer(self, d: str, bytes_: np.ndarray, keep: list | None) -> np.ndarray:
        """Logits (steps, rows, labels) from one direction; bytes_ is (steps, rows)."""
        p = self.p
        h = np.zeros((bytes_.shape[1], p[f"{d}o"].shape[0]), np.float32)
        out = np.empty((*bytes_.shape, p[f"{d}o"].shape[1]), np.float32)
        half = np.float32(0.5)
        for t in range(len(bytes_)) if d == "f" else reversed(range(len(bytes_))):
            x = bytes_[t]
            z = np.take(p[f"{d}z"], x, axis=0)
            z += h @ p[f"{d}Uz"]
            z *= half
            np.tanh(z, out=z)
            z *= half
            z += half
            r = np.take(p[f"{d}r"], x, axis=0)
            r += h @ p[f"{d}Ur"]
            r *= half
            np.tanh(r, out=r)
            r *= half
            r += half
            c = np.take(p[f"{d}c"], x, axis=0)
            rh = r * h
            c += rh @ p[f"{d}Uc"]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((t, h, z, r, c, rh))
                h = h + z * (c - h)
            else:
                c -= h
                c *= z
                h += c
            np.matmul(h, p[f"{d}o"], out=out[t])
            if keep is not None:
                keep[-1] += (h,)
        return out

    def probabilities(self, bytes_: np.ndarray) -> np.ndarray:
        """(steps, rows, labels) for bytes (steps, rows)."""
        logits = self._layer("f", bytes_, None)
        logits += self._layer("b", bytes_, None)
        logits += self.p["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def gradients(self, bytes_: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of the positions in mask, and its gradients by backpropagation through time."""
        p, kept = self.p, {"f": [], "b": []}
        logits = self._layer("f", bytes_, kept["f"]) + self._layer("b", bytes_, kept["b"]) + p["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        rows = np.arange(bytes_.shape[1])
        n = max(1.0, float(mask.sum()))
        loss = -float((np.log(prob[:, rows, labels] + 1e-9) * mask).sum()) / n
        prob[:, rows, labels] -= 1
        prob *= (mask / n)[:, :, None].astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["bias"] = prob.sum(axis=(0, 1))
        for d in "fb":
            dh = np.zeros_like(kept[d][0][1])
            for t, h, z, r, c, rh, new in reversed(kept[d]):
                g[f"{d}o"] += new.T @ prob[t]
                dh = dh + prob[t] @ p[f"{d}o"].T
                dz = dh * (c - h) * z * (1 - z)
                dc = dh * z * (1 - c * c)
                drh = dc @ p[f"{d}Uc"].T
                dr = drh * h * r * (1 - r)
                for k, own in (("z", dz), ("r", dr), ("c", dc)):
                    np.add.at(g[f"{d}{k}"], bytes_[t], own)
                g[f"{d}Uz"] += h.T @ dz
                g[f"{d}Ur"] += h.T @ dr
                g[f"{d}Uc"] += rh.T @ dc
                dh = dh * (1 - z) + drh * r + dz @ p[f"{d}Uz"].T + dr @ p[f"{d}Ur"].T
        return loss, g

    def fit(self, bytes_: np.ndarray, labels: np.ndarray, mask: np.ndarray, steps: int, batch: int = 192, rate: float = 0.02, seed: int = 11) -> ByteGru:
        """Adam on random batches of windows: bytes_ and mask are (windows, WINDOW)."""
        random = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            pick = random.integers(0, len(bytes_), batch)
            _, g = self.gradients(bytes_[pick].T, labels[pick], mask[pick].T)
            now = rate * (1 - (step - 1) / steps)
            for k, x in self.p.items():
                own = np.clip(g[k], -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * own
                v[k] = 0.99 * v[k] + 0.01 * own * own
                x -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def cut_windows(data: np.ndarray, begins: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (window, rows), which of them are text, and each row's text number. Texts end in a newline, which is not read."""
    lengths = np.diff(begins) - 1
    pieces = -(-lengths // window)
    of = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = begins[:-1][of] + nth * window
    left = begins[1:][of] - 1 - starts
    inside = np.arange(window)[:, None] < left[None, :]
    index = np.minimum(starts[None, :] + np.arange(window)[:, None], max(0, len(data) - 1))
    return np.where(inside, data[index], 0).astype(np.uint8), inside, of


def sample_windows(docs: DataFrame, learn, per_language: int = PER_LANGUAGE, per_text: int = PER_TEXT) -> list:
    """Rows (lang, window): up to ``per_text`` windows, spread over the whole text, of up to ``per_language`` texts for each language."""
    ship(docs.sparkSession)
    known = docs.filter(learn & F.col("lang").isNotNull()).select("doc_id", "lang", F.xxhash64("doc_id").alias("chance")).distinct()
    # no window sees a language's every text
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")).select(F.col("lang").alias("of"), "texts")  # one row per language
    known = known.join(F.broadcast(counts), F.col("lang") == F.col("of")).filter(within_share(F.col("chance"), F.col("texts"), 2 * per_language)).drop("of", "texts")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("chance", "doc_id"))
    chosen = known.withColumn("rank", rank).filter(F.col("rank") <= per_language).select(F.col("doc_id").alias("chosen")).distinct()
    texts = docs.filter(learn & F.col("lang").isNotNull()).join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"), "left_semi")
    # of an id's several rows in a language one is learned from, so at most per_language texts of each language count
    texts = texts.groupBy("doc_id", "lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.hash("text"))).alias("text")).select("lang", "text")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_text_batches(batches, "text"):
            data, begins = joined_bytes(batch.column(1))
            lang, out = [], []
            for i, name in enumerate(batch.column(0).to_pylist()):
                text = data[begins[i] : begins[i + 1] - 1]
                starts = np.linspace(0, max(0, len(text) - WINDOW), per_text).astype(int) if len(text) > WINDOW else [0]
                for at in sorted(set(map(int, starts))):
                    if len(text):
                        lang.append(name)
                        out.append(text[at : at + WINDOW].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(out, pa.binary())], names=["lang", "window"])

    rows = texts.mapInArrow(pick, "lang string, window binary").collect()
    return sorted((r.lang, bytes(r.window)) for r in rows)


def train(docs: DataFrame, learn, steps: int = 500, per_language: int = PER_LANGUAGE, hidden: int = HIDDEN) -> tuple[list[str], ByteGru | None]:
    """Language names and a network, learned from rows where ``learn`` holds and lang is set. Without such texts there is none."""
    names = sorted(r.lang for r in docs.filter(learn & F.col("lang").isNotNull()).select("lang").distinct().collect())
    # the sample is bounded in all: of more than LANGUAGES languages each gives fewer texts, one at least
    windows = sample_windows(docs, learn, max(1, min(per_language, per_language * LANGUAGES // len(names)))) if names else []
    if not windows:
        return [], None
    data = np.zeros((len(windows), WINDOW), np.uint8)
    mask = np.zeros((len(windows), WINDOW), np.float32)
    for i, (_, w) in enumerate(windows):
        data[i, : len(w)] = np.frombuffer(w, np.uint8)
        mask[i, : len(w)] = 1
    number = {name: i for i, name in enumerate(names)}
    labels = np.array([number[lang] for lang, _ in windows])
    return names, ByteGru(len(names), hidden).fit(data, labels, mask, steps)


def text_probabilities(model: ByteGru, column: pa.Array) -> np.ndarray:
    """Mean probabilities of each text's positions, (texts, labels); zeros for empty texts."""
    data, begins = joined_bytes(column)
    bytes_, inside, of = cut_windows(data, begins)
    total = np.zeros((len(begins) - 1, len(model.p["bias"])))
    for at in range(0, len(of), 4096):
        part = slice(at, at + 4096)
        held = (model.probabilities(bytes_[:, part]) * inside[:, part, None]).sum(axis=0, dtype=np.float64)
        np.add.at(total, of[part], held)
    return total / np.maximum(1, np.diff(begins) - 1)[:, None]


def identify(docs: DataFrame, names: list[str], model: ByteGru | None, language: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with two columns more: the predicted language and its probability (0 to 1, six digits).

    Columns of docs with these names are replaced. Only ``text`` is read. A text that is null or has no letter is `und` with score 0, as is every
    text if nothing could be learned. Equal probabilities go to the first name in order. A row
    comes back for each row (repeated ones too; none for an empty table), with all its other columns.
    """
    docs = docs.select(*quoted([c for c in docs.columns if c not in (language, score)]))
    if model is None:
        return docs.withColumns({language: F.lit(UNDETERMINED), score: F.lit(0.0)})
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((names, model))
    letters = "__has_letter"
    marked = docs.withColumn(letters, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    marked = marked.toDF(*[f"c{i}" for i in range(len(marked.columns))])  # Spark takes no names with dots below
    carried = docs.columns
    column = carried.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, net = shared.value
        for batch in split_text_batches(batches, f"c{column}"):
            prob = text_probabilities(net, batch.column(column))
            best = prob.argmax(axis=1)
            sure = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            value = np.where(sure, np.clip(np.round(prob[np.arange(len(best)), best], 6), 0, 1), 0.0)
            label = [known[b] if s else UNDETERMINED for b, s in zip(best.tolist(), sure.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(label, pa.string()), pa.array(value, pa.float64())], names=[*carried, language, score])

    return marked.mapInArrow(rows, T.StructType([*docs.schema.fields, T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())]))


def fold(doc_id, folds: int):
    """crc32 of the id as text, modulo ``folds``; null without an id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def language_id(docs: DataFrame, language: str = "lang_pred", score: str = "score") -> DataFrame:
    """Learn from the rows with a language whose id is not in the held-out fold (crc32 modulo 3 is 1), then identify every row."""
    names, model = train(docs, F.coalesce(fold("doc_id", 3) != 1, F.lit(False)))
    return identify(docs, names, model, language, score)
