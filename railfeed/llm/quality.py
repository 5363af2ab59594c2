"""Document quality by attention-based multiple-instance learning over passages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from railfeed.llm.common import schema_of, slices, table, texts

PASSAGE_WORDS = 80
TRAIN_DOCS = 6_000
TRAIN_PASSAGES = 64
#: Signs with a class of their own; letters, digits, spaces and other bytes have one class each.
_SIGNS = b".,;:!?|#*%$&@=+/\\-_\"'()[]{}<>~\n"
_OTHER = 6 + len(_SIGNS)
_CLASS = np.full(256, _OTHER, np.int64)
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = 0, 1, 2
_CLASS[[32, 9, 11, 12, 13]], _CLASS[128:192], _CLASS[192:] = 3, 4, 5
_CLASS[list(_SIGNS)] = np.arange(6, 6 + len(_SIGNS))
FEATURES = _OTHER + 1 + 7


def passage_features(text: str | None, words_per_passage: int = PASSAGE_WORDS) -> np.ndarray:
    """One row per run of words: shares of byte classes, and how long, varied and repetitive its words are.

    A NULL or empty text is one passage of zeros.
    """
    words = (text or "").split(" ")
    rows = np.zeros((-(-len(words) // words_per_passage), FEATURES))
    for k in range(len(rows)):
        part = words[k * words_per_passage : (k + 1) * words_per_passage]
        raw = np.frombuffer(" ".join(part).encode("utf-8", "surrogatepass"), np.uint8)
        if not len(raw):
            continue
        n, at = len(part), _OTHER + 1
        rows[k, :at] = np.bincount(_CLASS[raw], minlength=at) / len(raw)
        rows[k, at] = len(set(part)) / n
        rows[k, at + 1] = sum(map(str.__eq__, part, part[1:])) / n
        rows[k, at + 2] = min(3.0, len(raw) / n / 8)
        rows[k, at + 3] = min(3.0, max(map(len, part)) / 16)
        rows[k, at + 4] = sum(map(str.isupper, part)) / n
        rows[k, at + 5] = n / words_per_passage
        rows[k, at + 6] = 1.0
    return rows


class AttentionModel:
    """h = tanh(Wx + b); attention from tanh(Vh) * sigmoid(Uh); score = sigmoid(c . sum(a h) + d)."""

    def __init__(self, prior: float, params: dict | None = None, mean=None, scale=None):
        self.prior, self.params, self.mean, self.scale = prior, params, mean, scale

    def _forward(self, x: np.ndarray, starts: np.ndarray):
        p = self.params
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (v * u) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return bag, h, v, u, a, z, s

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.params is None or not bags:
            return np.full(len(bags), self.prior)
        starts = np.cumsum([0, *(len(b) for b in bags[:-1])])
        return self._forward((np.concatenate(bags) - self.mean) / self.scale, starts)[-1]

    @classmethod
    def fit(cls, bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 40, seed: int = 7):
        """Adam on the log loss with each label given half of the weight. Without both labels, a constant prior."""
        ones = int(labels.sum())
        prior = (ones + 1) / (len(labels) + 1)
        if ones in (0, len(labels)):
            return cls(prior)
        every = np.concatenate(bags)
        mean, scale = every.mean(axis=0), np.maximum(every.std(axis=0), 1e-3)
        bags = [np.clip((b - mean) / scale, -8, 8) for b in bags]
        rng = np.random.default_rng(seed)
        make = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        p = {"W": make(FEATURES, hidden), "b": np.zeros(hidden), "V": make(hidden, gate), "U": make(hidden, gate)}
        p |= {"w": make(gate), "c": make(hidden), "d": np.zeros(())}
        model = cls(prior, p, mean, scale)
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        step = 0
        weight = np.where(labels == 1, 0.5 / ones, 0.5 / (len(labels) - ones)) * len(labels)
        for epoch in range(epochs):
            rate = 0.01 * (0.5 ** (epoch // 12))
            for part in np.array_split(rng.permutation(len(bags)), max(1, len(bags) // 128)):
                x = np.concatenate([bags[i] for i in part])
                starts = np.cumsum([0, *(len(bags[i]) for i in part[:-1])])
                bag, h, v, u, a, z, s = model._forward(x, starts)
                ds = weight[part] * (s - labels[part]) / len(part)
                dz = ds[:, None] * p["c"]
                da = (dz[bag] * h).sum(axis=1)
                de = a * (da - np.add.reduceat(a * da, starts)[bag])
                dv, du = de[:, None] * p["w"] * u * (1 - v * v), de[:, None] * p["w"] * v * u * (1 - u)
                dh = (a[:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
                grads = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ de}
                grads |= {"c": z.T @ ds, "d": ds.sum()}
                step += 1
                for k, g in grads.items():
                    g = g + 1e-4 * p[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    p[k] = p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return model


def held_out(id_column="doc_id"):
    """Rows that no label may be learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", train_docs: int = TRAIN_DOCS) -> AttentionModel:
    """Fit on at most ``train_docs`` labelled rows outside the held-out part, chosen by a hash of the id.

    Of each, at most TRAIN_PASSAGES passages spread evenly over the text are used. Rows without a label or an id are
    left out; of contradicting labels the smaller counts.
    """
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min(target).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    chosen = texts(docs).join(F.broadcast(known), "doc_id")  # bounded by train_docs
    schema = StructType.fromDDL("doc_id STRING, label INT, passages INT, features BINARY")

    def run(batches):
        for part in slices(batches):
            rows = []
            for doc, text, label in zip(*(part.column(i).to_pylist() for i in range(3))):
                bag = passage_features(text)
                if len(bag) > TRAIN_PASSAGES:
                    bag = bag[np.linspace(0, len(bag) - 1, TRAIN_PASSAGES).astype(int)]
                rows.append((str(doc), label, len(bag), bag.astype("<f4").tobytes()))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary()]
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=schema.names)

    rows = chosen.select("doc_id", "text", "label").mapInArrow(run, schema).collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.features)))
    bags = [np.frombuffer(r.features, "<f4").reshape(r.passages, FEATURES).astype(float) for r in rows]
    return AttentionModel.fit(bags, np.array([r.label for r in rows], float))


def _score_column(model: AttentionModel, column: pa.Array) -> np.ndarray:
    return model.scores([passage_features(t) for t in column.to_pylist()])


def score(docs: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every row from its text alone.

    NULL and empty texts get a score too. Repeated rows repeat, NULL ids stay, other columns are ignored, an empty
    table gives no rows. Without labels of both kinds the score is the share of label 1, and 1 without any labels.
    """
    frame = texts(docs, id_col, text_col)

    def run(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_score_column(model, part.column(1)))], names=["doc_id", "score"])

    return frame.mapInArrow(run, schema_of(frame, "score DOUBLE"))


def keep_good(docs: DataFrame, model: AttentionModel, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score reaches the threshold; no shuffle."""

    def run(batches):
        for part in slices(batches):
            mask = _score_column(model, part.column(part.schema.get_field_index("text"))) >= threshold
            yield part.filter(pa.array(mask))

    return docs.mapInArrow(run, docs.schema)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
