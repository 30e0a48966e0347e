"""Language identification by a bidirectional gated recurrent network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridops.llm.common import flat_bytes, slices, stage
from gridops.llm.units import distinct, word_spans
from gridops.session import bounded_broadcast

#: Label of texts without a letter.
UNKNOWN = "und"
#: Longest run of bytes that the network reads at once; longer words are cut, no byte is left out.
SPAN = 24


@dataclass
class Cell:
    """One direction: a table of input weights by byte, the recurrent weights, update, reset and candidate gate in a row."""

    wx: np.ndarray  # 256 x 3H
    uh: np.ndarray  # H x 3H

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """States after each of the columns of ``x`` (rows x length), and what the backward pass needs."""
        n, width = len(x), self.uh.shape[0]
        h, states, tape = np.zeros((n, width), self.wx.dtype), [], []
        for column in x.T:
            into, rec = self.wx[column], h @ self.uh
            gates = 1 / (1 + np.exp(-(into[:, : 2 * width] + rec[:, : 2 * width])))
            z, r = gates[:, :width], gates[:, width:]
            c = np.tanh(into[:, 2 * width :] + r * rec[:, 2 * width :])
            tape.append((h, z, r, c, rec[:, 2 * width :], column))
            h = h + z * (c - h)
            states.append(h)
        return np.stack(states, axis=1), tape

    def backward(self, grads: np.ndarray, tape: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the weights, back through time, from those of the states."""
        width = self.uh.shape[0]
        gx, gu, carry = np.zeros_like(self.wx), np.zeros_like(self.uh), 0
        for t in range(len(tape) - 1, -1, -1):
            h, z, r, c, rec_c, column = tape[t]
            dh = grads[:, t] + carry
            dc = dh * z * (1 - c * c)
            da = np.concatenate([dh * (c - h) * z * (1 - z), dc * rec_c * r * (1 - r), dc], axis=1)
            db = np.concatenate([da[:, : 2 * width], dc * r], axis=1)
            np.add.at(gx, column, da)
            gu += h.T @ db
            carry = dh * (1 - z) + db @ self.uh.T
        return gx, gu


@dataclass
class Network:
    ahead: Cell
    behind: Cell
    out: np.ndarray  # 2H x languages
    bias: np.ndarray
    labels: list[str]

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Label log-probabilities of every position: rows x length x languages."""
        return _log_softmax(self._states(x)[0] @ self.out + self.bias)

    def _states(self, x: np.ndarray):
        f, tape_f = self.ahead.forward(x)
        b, tape_b = self.behind.forward(x[:, ::-1])
        return np.concatenate([f, b[:, ::-1]], axis=2), tape_f, tape_b

    def step(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy over all positions of equally long rows."""
        states, tape_f, tape_b = self._states(x)
        wrong = np.exp(_log_softmax(states @ self.out + self.bias))
        wrong[np.arange(len(y)), :, y] -= 1
        wrong /= wrong.shape[0] * wrong.shape[1]
        width = self.ahead.uh.shape[0]
        into = wrong @ self.out.T
        ahead = self.ahead.backward(into[:, :, :width], tape_f)
        behind = self.behind.backward(into[:, ::-1, width:], tape_b)
        flat = states.reshape(-1, 2 * width)
        return [*ahead, *behind, flat.T @ wrong.reshape(len(flat), -1), wrong.sum((0, 1))]

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.wx, self.ahead.uh, self.behind.wx, self.behind.uh, self.out, self.bias]


def _log_softmax(a: np.ndarray) -> np.ndarray:
    a = a - a.max(axis=-1, keepdims=True)
    return a - np.log(np.exp(a).sum(axis=-1, keepdims=True))


def train_network(
    words: list[tuple[str, bytes, int]], hidden: int = 8, steps: int = 600, batch: int = 256, rate: float = 0.01, seed: int = 7
) -> Network:
    """Fit the network to ``(label, word, count)`` rows, labels drawn evenly, words by count, with Adam."""
    rng = np.random.default_rng(seed)
    labels = sorted({w[0] for w in words})
    draw = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
    cell = lambda: Cell(draw(256, 3 * hidden), draw(hidden, 3 * hidden))
    net = Network(cell(), cell(), draw(2 * hidden, len(labels)), np.zeros(len(labels), np.float32), labels)
    rows: dict[int, list[tuple[int, bytes, int]]] = {}
    for label, word, count in sorted(words):
        for at in range(0, len(word), SPAN):
            rows.setdefault(min(SPAN, len(word) - at), []).append((labels.index(label), word[at : at + SPAN], count))
    groups = []
    totals = np.zeros(len(labels))
    for length, group in sorted(rows.items()):
        y = np.array([g[0] for g in group])
        count = np.array([g[2] for g in group], float)
        np.add.at(totals, y, count)
        groups.append((np.frombuffer(b"".join(g[1] for g in group), np.uint8).reshape(-1, length), y, count))
    groups = [(x, y, c / totals[y]) for x, y, c in groups]
    share = np.array([c.sum() for _, _, c in groups])
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, steps + 1):
        x, y, c = groups[rng.choice(len(groups), p=share / share.sum())]
        pick = rng.choice(len(y), batch, p=c / c.sum())
        lr = rate * (1 - step / (steps + 1))
        for w, g, m, v in zip(net.weights(), net.step(x[pick], y[pick]), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned_documents(docs: DataFrame, docs_per_language: int = 400, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, text`` of the bounded sample that is learned from.

    Of the documents that may be learned from (text and language given, not held out),
    the ``docs_per_language`` whose hashes of id and text are lowest, repeated rows once.
    The documents are not ranked: hashes are counted in 65,536 places a language, which
    tells up to what place the lowest stand, and only rows up to there are looked at.
    """
    usable = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~is_held_out(id_col))
    text, lang = F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    hashed = usable.select(lang, text, F.xxhash64(F.col(id_col), text).alias("hash")).withColumn("place", F.shiftright("hash", 48))
    counts = hashed.select("lang", "place", "hash").distinct().groupBy("lang", "place").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("place")) - F.col("n")
    cuts = counts.withColumn("before", before).where(F.col("before") < docs_per_language).groupBy("lang").agg(F.max("place").alias("cut"))
    # One row per language; then a few hundred documents of each.
    cuts = bounded_broadcast(stage(cuts, "cuts"))
    low = stage(hashed.join(cuts, "lang").where(F.col("place") <= F.col("cut")).select("lang", "hash", "text").dropDuplicates(["lang", "hash"]), "sample")
    by_hash = Window.partitionBy("lang").orderBy("hash")
    picked = low.select("lang", "hash").withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= docs_per_language)
    return low.join(picked.drop("n"), ["lang", "hash"]).select("lang", "text")


def training_words(docs: DataFrame, docs_per_language: int = 400, words_per_language: int = 20_000, **columns: str) -> list[tuple[str, bytes, int]]:
    """``label, word, count`` of the words that the network learns from: see ``sample_words``."""
    return sample_words(learned_documents(docs, docs_per_language, **columns), words_per_language)


def sample_words(sample: DataFrame, words_per_language: int = 20_000) -> list[tuple[str, bytes, int]]:
    """Of the distinct words of ``lang, text`` rows, counted over the whole texts, the ``words_per_language`` that hash lowest."""
    words = sample.select("lang", F.explode(F.split("text", "[ \\t-\\r]+")).alias("word"))
    counted = words.where(F.col("word") != "").groupBy("lang", "word").agg(F.count("*").alias("count"))
    by_word = Window.partitionBy("lang").orderBy(F.xxhash64("word"), "word")
    rows = counted.withColumn("n", F.row_number().over(by_word)).where(F.col("n") <= words_per_language).select("lang", "word", "count").collect()
    return [(r["lang"], r["word"].encode(), r["count"]) for r in rows]


def train(docs: DataFrame, **columns: str) -> Network | None:
    """The network learned from ``docs``; None if there is nothing to learn from."""
    words = training_words(docs, **columns)
    return train_network(words) if words else None


def classify_texts(net: Network | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.

    Every byte of every word gets log-probabilities; a word weighs its positions' mean,
    a text sums its words and the softmax of that sum is its score.
    """
    names, scores, _ = identified(net, texts)
    return names, scores


def typical(net: Network, texts: pa.Array) -> np.ndarray:
    """Mean log-probability of a text's best language over its words: does not depend on the length of a text."""
    return identified(net, texts)[2]


def identified(net: Network | None, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score (see ``classify_texts``) and ``typical`` value of each text, from one reading."""
    if net is None or not len(texts):
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), -np.inf)
    lettered = _lettered(texts)
    sums, words = _word_sums(net, texts)
    pooled = np.exp(_log_softmax(sums))
    best = pooled.argmax(axis=1)
    names = [net.labels[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
    return names, np.where(lettered, pooled[np.arange(len(best)), best], 0.0), sums.max(axis=1, initial=-np.inf) / np.maximum(words, 1)


def _lettered(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def _word_sums(net: Network, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """By text: the sum of its words' mean log-probabilities, and the number of words."""
    data, offsets = flat_bytes(texts)
    starts, ends, _ = word_spans(data, offsets)
    # Cut words longer than a span.
    cut = np.zeros(len(data), bool)
    long = ends - starts > SPAN
    for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        cut[a + SPAN : b : SPAN] = True
    starts, ends, by_text = word_spans(data, offsets, cut)
    sums = np.zeros((len(starts) + 1, len(net.labels)))
    if len(starts):
        which, words = distinct(data, starts, ends)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        weights = np.zeros((len(words), len(net.labels)))
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            for i in range(0, len(rows), 4096):
                some = rows[i : i + 4096]
                x = np.frombuffer(b"".join([words[k] for k in some.tolist()]), np.uint8).reshape(-1, size)
                weights[some] = net.log_probabilities(x).mean(axis=1)
        np.cumsum(weights[which], axis=0, out=sums[1:])
    return sums[by_text[1:]] - sums[by_text[:-1]], np.diff(by_text)


def predict_language(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; only the text is an input.

    Without ``net`` the network is trained on ``docs`` first. A null text, or one
    without a letter, is ``und`` with score 0; so is every text if nothing could be
    learned. A null doc_id is not held out. Other columns are ignored; rows keep their
    partitions and an empty table gives no rows.
    """
    net = net or train(docs, id_col=id_col, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names, scores = classify_texts(net, batch["text"])
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(names), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), is_held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def calibrated(sample: DataFrame, net: Network) -> float:
    """The ``typical`` value below which a text is like none of the ``lang, text`` rows of a bounded sample.

    The least of them still counts as a language, and so does what is not further below it than it is below
    their median. Two numbers come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.record_batch([pa.array(typical(net, batch["text"]))], ["value"])

    values = sample.select("text").where(F.col("text").rlike(r"\p{L}")).mapInArrow(run, "value double")
    told = values.agg(F.min("value").alias("least"), F.percentile_approx("value", 0.5).alias("median")).first()
    return -np.inf if told["least"] is None else 2 * told["least"] - told["median"]


def keep_identified(docs: DataFrame, net: Network | None = None, least: float | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are in a language, with the language that the network finds in the text as ``lang_col``.

    Every row gets the language of ``classify_texts``, in the type of that column, whatever stood there; a column that is
    missing is added. All other columns are as they are, whatever their names. Rejected are texts without a letter, and
    texts whose words the network finds less typical of any language (mean log-probability, see ``typical``) than ``least``;
    by default that is ``calibrated`` on the documents learned from, with as much room below the least of them as it is
    below their median. Where nothing can be learned, every text with a letter stays, with the label it has.
    """
    if net is None or least is None:
        sample = learned_documents(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
        words = sample_words(sample) if net is None else []
        net = net or (train_network(words) if words else None)
        if net is not None and least is None:
            least = calibrated(sample, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            keep, names = _lettered(batch[text]), [None] * batch.num_rows
            if net is not None and len(keep):
                names, _, values = identified(net, batch[text])
                keep = keep & (values >= least)
            told = pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string())], [*batch.schema.names, "told"])
            yield told.filter(pa.array(keep, pa.bool_()))

    if lang_col not in docs.columns:
        docs = docs.withColumn(lang_col, F.lit(None).cast("string"))
    # By number, as Arrow functions take no column whose name has a dot.
    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text, lang = (numbered.columns[docs.columns.index(c)] for c in (text_col, lang_col))
    kept = numbered.mapInArrow(run, T.StructType([*numbered.schema.fields, T.StructField("told", T.StringType())]))
    found = F.col("told").cast(numbered.schema[lang].dataType) if net is not None else F.col(lang)
    return kept.select(*(found.alias(c) if c == lang else F.col(c) for c in numbered.columns)).toDF(*docs.columns)
