"""Language ID: a convolutional network over bytes.

Filters of several widths slide over windows of a fixed number of bytes, each filter keeps its maximum, and a softmax
layer reads those maxima. The network is trained in numpy on a bounded sample of labelled windows; every byte of every
text is scored, window by window, in batches.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text if no label was there
to learn from. A text's score is the softmax of its windows' mean logits, weighted by their bytes. Rows with a null
label or text are not learned from. Repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edilake.llm import tokens

WIDTHS = (2, 3, 4)
FILTERS = 8
WINDOW = 256
LETTER = regex.compile(r"\p{L}")


class ByteCnn:
    """One-hot bytes make a filter a sum of table rows, one row per byte under it."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.dense = rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(classes))).astype(np.float32)
        self.dense_bias = np.zeros(len(classes), np.float32)
        self.pairs = None

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.bias, self.dense, self.dense_bias]

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 7):
        """Adam on the cross-entropy of windows ``x`` (uint8) with class numbers ``y``."""
        rng = np.random.default_rng(seed)
        params = self.parameters()
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        # classes weigh alike, however many rows they have
        weight = np.bincount(y, minlength=len(self.classes)).astype(np.float32)
        weight = weight.sum() / np.maximum(1, weight) / len(self.classes)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                grads = self._gradients(x[rows], y[rows], weight[y[rows]])
                step += 1
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)
        self.pairs = None
        return self

    def _gradients(self, x, y, weight):
        n = np.arange(len(x))
        tops, hidden = [], []
        for w, table, bias in zip(WIDTHS, self.tables, self.bias, strict=True):
            z = sum(table[k][x[:, k:WINDOW - w + 1 + k]] for k in range(w))
            top = z.argmax(axis=1)
            tops.append(top)
            hidden.append(np.maximum(0, np.take_along_axis(z, top[:, None], 1)[:, 0] + bias))
        h = np.concatenate(hidden, axis=1)
        logits = h @ self.dense + self.dense_bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[n, y] -= 1
        p *= weight[:, None] / len(x)
        back = (p @ self.dense.T) * (h > 0)
        table_grads, bias_grads = [], []
        for i, (w, table, top) in enumerate(zip(WIDTHS, self.tables, tops, strict=True)):
            part = back[:, i * FILTERS:(i + 1) * FILTERS]
            grad = np.zeros_like(table)
            for k in range(w):
                np.add.at(grad[k], (x[n[:, None], top + k], np.arange(FILTERS)), part)
            table_grads.append(grad)
            bias_grads.append(part.sum(axis=0))
        return [*table_grads, *bias_grads, h.T @ p, p.sum(axis=0)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Scores of many windows. Rows of two neighbouring bytes are summed once, for all byte pairs."""
        if self.pairs is None:
            self.pairs = {(i, k): (t[k][:, None] + t[k + 1][None]).reshape(65536, FILTERS)
                          for i, (w, t) in enumerate(zip(WIDTHS, self.tables, strict=True)) for k in range(0, w - 1, 2)}
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        hidden = []
        for i, (w, table, bias) in enumerate(zip(WIDTHS, self.tables, self.bias, strict=True)):
            m = WINDOW - w + 1
            z = None
            for k in range(0, w, 2):
                part = self.pairs[i, k].take(pair[:, k:k + m], axis=0) if k + 1 < w else table[k].take(x[:, k:k + m], axis=0)
                z = part if z is None else np.add(z, part, out=z)
            hidden.append(np.maximum(0, z.max(axis=1) + bias))
        return np.concatenate(hidden, axis=1) @ self.dense + self.dense_bias


def windows(text: bytes) -> np.ndarray:
    """The text's consecutive windows, the last one filled up with spaces; A-Z lower-cased."""
    n = -(-len(text) // WINDOW)
    return tokens.LOWER[np.frombuffer(text.ljust(n * WINDOW), np.uint8)].reshape(n, WINDOW)


def training_rows(docs: DataFrame, usable, label: str = "lang", per_class: int = 1500, most: int = 96_000,
                  crops: int = 2) -> DataFrame:
    """A bounded sample of labelled text windows: of every label about ``per_class`` documents, or fewer where there are so
    many labels that all together would be over ``most``, chosen by hash, and ``crops`` windows of each at hashed places of
    the whole text."""
    rows = docs.where(usable & F.col(label).isNotNull() & (F.length("text") > 0))
    # as many numbers as the network has outputs
    counts = rows.groupBy(label).agg(F.count("*").alias("__n")).collect()
    each = max(1, min(per_class, most // max(1, len(counts))))
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r[label], min(1.0, each / r["__n"]))]) if counts else None
    share = F.lit(0.0) if shares is None else F.coalesce(F.element_at(shares, F.col(label)), F.lit(0.0))
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    crop = F.explode(F.transform(F.sequence(F.lit(1), F.lit(crops)), lambda i: F.substring(
        F.col("text"), (F.pmod(F.hash("text", i), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))) + 1).cast("int"), F.lit(WINDOW))))
    return (rows.where(chance < share).select(F.col(label).alias("label"), crop.alias("window"))
            .orderBy(F.xxhash64("window"), "label", "window").limit(most * crops))


def train(sample: list[tuple[str, str]], seed: int = 7) -> ByteCnn | None:
    """A network from (label, window) rows; a third of the windows are shortened, as the last window of a text is."""
    sample = [(label, w.encode()[:WINDOW]) for label, w in sample if label is not None and w]
    if not sample:
        return None
    rng = np.random.default_rng(seed)
    classes = sorted({label for label, _ in sample})
    number = {label: i for i, label in enumerate(classes)}
    x = np.concatenate([windows(w[:int(rng.integers(12, WINDOW))] if rng.random() < 0.35 else w) for _, w in sample])
    return ByteCnn(classes, seed).train(x, np.array([number[label] for label, _ in sample]))


def fit(docs: DataFrame, usable, label: str = "lang", **bounds) -> ByteCnn | None:
    return train([(r["label"], r["window"]) for r in training_rows(docs, usable, label, **bounds).collect()])


def predict(texts: list[bytes], model: ByteCnn | None) -> tuple[list[str], list[float]]:
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if model is None:
        return langs, scores
    judged = [i for i, t in enumerate(texts) if t and LETTER.search(t.decode("utf-8", "replace"))]
    total = {i: np.zeros(len(model.classes)) for i in judged}
    for group in tokens.chunks(((i, at) for i in judged for at in range(0, len(texts[i]), 1 << 18)),
                               lambda x: min(1 << 18, len(texts[x[0]]) - x[1]), 1 << 18):
        pieces = [texts[i][at:at + (1 << 18)] for i, at in group]
        parts = [windows(p) for p in pieces]
        logits = model.logits(np.concatenate(parts))
        # a window counts by the bytes it holds
        held = np.full(len(logits), float(WINDOW))
        ends = np.cumsum([len(p) for p in parts])
        held[ends - 1] -= [len(p) * WINDOW - len(t) for p, t in zip(parts, pieces, strict=True)]
        sums = np.add.reduceat(logits * held[:, None], np.concatenate((np.zeros(1, np.int64), ends[:-1])))
        for (i, _), s in zip(group, sums, strict=True):
            total[i] += s
    for i in judged:
        z = total[i] / len(texts[i])
        p = np.exp(z - z.max())
        best = int(p.argmax())
        langs[i], scores[i] = model.classes[best], float(p[best] / p.sum())
    return langs, scores


def identify(docs: DataFrame, model: ByteCnn | None, text: str = "text") -> DataFrame:
    """``docs`` with columns ``lang_pred`` and ``score`` (columns of those names are replaced)."""
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    kept = docs.select(*(F.col(f"`{c}`") for c in rest))
    schema = kept.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema

    def run(batches):
        for batch in batches:
            langs, scores = predict(tokens.text_column(batch, text), model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*rest, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: ByteCnn | None, least: float = 0.5) -> DataFrame:
    """``docs`` without those that have no letter or whose language is uncertain (score under ``least``)."""
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def run(batches):
        for batch in batches:
            langs, scores = predict(tokens.text_column(batch), model)
            yield batch.filter(pa.array([lang != "und" and s >= least for lang, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    model = fit(docs, ~held_out())
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))
