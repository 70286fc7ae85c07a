"""Quality of texts by attention over passages, learnt from labels of whole documents.

A text is cut into passages of ``PASSAGE`` bytes. Each is encoded as counts of pairs of
character classes (in logarithms), and by a learnt layer. Gated attention gives each
passage a weight within its document; the weighted sum of the encoded passages is
scored. Encoder, attention and score are trained together on the document labels, so
the model learns by itself which passages decide. Scores are calibrated on
labelled documents that were held out from training.

Training uses at most ``TRAIN_LABELS`` labelled documents in order of a hash of their
id, never those whose crc32(id) mod 4 is 2. Of rows with equal ids one text is learnt from, the
first by hash. The documents are taken in that order while their passages are at most
``TRAIN_PASSAGES`` together; one that does not fit is left out. Only the text enters a score. Labels other
than 0 and 1 and documents without text are not learnt from; of contradicting labels
the lower counts. Null and empty texts are one empty passage and get a score. Without
labels of both kinds every score is 0.5. An empty table gives no rows; repeated rows
are scored each; other columns stay as they are.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 512
TRAIN_LABELS = 4000
TRAIN_PASSAGES = 65_536  # of 1,600 bytes each on the driver
THRESHOLD = 0.7
_CLASSES = 20
_HIDDEN, _GATE = 24, 12
_GROUPS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789",
           " ", "\n\r", "\t\x0b\x0c", ".", ",;:", "!?", "'\"`", "()[]{}<>", "#", "$%&", "*+=~^",
           "-_/\\", "|@")
_CLASS = np.full(256, _CLASSES - 1, np.uint8)
_CLASS[:128] = _CLASSES - 2
for _i, _group in enumerate(_GROUPS):
    _CLASS[[ord(c) for c in _group]] = _i
FEATURES = _CLASSES * _CLASSES


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and how many belong to each text (one at least)."""
    parts = [(t or "").encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    classes = _CLASS[np.frombuffer(b"".join(parts), np.uint8)].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts
    starts = np.cumsum(sizes) - sizes
    inside = np.arange(len(classes)) - np.repeat(starts, sizes)
    owner = np.repeat(first, sizes) + inside // PASSAGE
    following = np.empty_like(classes)
    following[:-1] = classes[1:]
    following[np.cumsum(sizes)[sizes > 0] - 1] = _CLASSES - 2  # the end of a text
    total = int(counts.sum())
    pairs = np.bincount(
        owner * FEATURES + classes * _CLASSES + following, minlength=total * FEATURES
    )
    table = pairs.reshape(total, FEATURES).astype(np.float32)
    table /= np.maximum(table.sum(1, keepdims=True), 1)
    return np.log1p(200 * table), counts


@dataclass
class Attention:
    mean: np.ndarray
    spread: np.ndarray
    params: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0

    def _forward(self, x: np.ndarray, counts: np.ndarray):
        p = self.params
        heads = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh((x - self.mean) / self.spread @ p["W"] + p["b"])
        t = np.tanh(h @ p["V"])
        g = 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, heads)[owner])
        weight = e / np.add.reduceat(e, heads)[owner]
        z = np.add.reduceat(h * weight[:, None], heads)
        return heads, owner, h, t, g, weight, z, z @ p["w"] + p["c"][0]

    def logits(self, x, counts) -> np.ndarray:
        return self._forward(x, counts)[-1] if len(counts) else np.empty(0)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x, counts = passages(texts)
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x, counts) + self.shift, -30, 30)))

    def gradients(self, x, counts, truth):
        p = self.params
        heads, owner, h, t, g, weight, z, logit = self._forward(x, counts)
        error = (1 / (1 + np.exp(-logit)) - truth) / len(truth)
        dz = error[:, None] * p["w"]
        dweight = (h * dz[owner]).sum(1)
        mean = np.add.reduceat(weight * dweight, heads)[owner]
        de = weight * (dweight - mean)
        gate = de[:, None] * p["a"]
        dt, dg = gate * g * (1 - t * t), gate * t * g * (1 - g)
        dh = weight[:, None] * dz[owner] + dt @ p["V"].T + dg @ p["U"].T
        dh *= 1 - h * h
        scaled = (x - self.mean) / self.spread
        return {
            "W": scaled.T @ dh + 1e-4 * p["W"], "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg,
            "a": (t * g).T @ de, "w": z.T @ error + 1e-4 * p["w"], "c": np.array([error.sum()]),
        }


def train(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, seed: int = 5, epochs: int = 12):
    """Train on four fifths of the documents, calibrate on the rest; None without both labels."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    starts = np.cumsum(counts) - counts

    def rows(docs):
        return np.concatenate([np.arange(starts[d], starts[d] + counts[d]) for d in docs])

    mine = x[rows(used)]
    params = {
        "W": rng.normal(0, 0.05, (FEATURES, _HIDDEN)), "b": np.zeros(_HIDDEN),
        "V": rng.normal(0, 0.2, (_HIDDEN, _GATE)), "U": rng.normal(0, 0.2, (_HIDDEN, _GATE)),
        "a": rng.normal(0, 0.2, _GATE), "w": rng.normal(0, 0.2, _HIDDEN), "c": np.zeros(1),
    }
    model = Attention(mine.mean(0), mine.std(0) + 0.1, {k: v.astype(np.float32) for k, v in params.items()})
    first = {k: np.zeros_like(v) for k, v in model.params.items()}
    second = {k: np.zeros_like(v) for k, v in model.params.items()}
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // 64)):
            step += 1
            grads = model.gradients(x[rows(batch)], counts[batch], labels[batch])
            rate = 0.005 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            for name, grad in grads.items():
                first[name] += 0.1 * (grad - first[name])
                second[name] += 0.01 * (grad * grad - second[name])
                model.params[name] -= (rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    if len(held):
        logits, truth = model.logits(x[rows(held)], counts[held]), labels[held]
        for _ in range(300):
            error = 1 / (1 + np.exp(-np.clip(model.scale * logits + model.shift, -30, 30))) - truth
            model.scale -= 0.1 * (float((error * logits).mean()) + 0.01 * (model.scale - 1))
            model.shift -= 0.1 * (float(error.mean()) + 0.01 * model.shift)
        model.scale = max(model.scale, 1e-3)
    return model


def fit(
    documents: DataFrame, labels: DataFrame, most: int = TRAIN_LABELS, most_passages: int = TRAIN_PASSAGES
) -> Attention | None:
    """Train on at most ``most`` labelled documents of ``documents``, and as many passages."""
    chosen = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("quality").cast("int").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(most)
    )
    texts = documents.select(
        F.col("doc_id").alias("__id"), F.col("text").alias("__text"), F.xxhash64("text").alias("__mark")
    ).filter("__text IS NOT NULL")
    size = F.greatest(F.lit(1), F.ceil(F.octet_length("__text") / PASSAGE)).cast("long")
    sizes = (
        texts.select("__id", "__mark", size.alias("__size"))
        .join(F.broadcast(chosen), "__id")
        .groupBy("__id", "__label", "__mark")
        .agg(F.max("__size").alias("__size"))
        .groupBy("__id", "__label")
        .agg(F.min(F.struct("__mark", "__size")).alias("__first"))
        .select("__id", "__label", "__first.*")
        .orderBy(F.xxhash64("__id"), "__id")
    )
    taken, total = [], 0
    for row in sizes.collect():
        if total + row["__size"] <= most_passages:
            taken.append((row["__id"], row["__label"], row["__mark"]))
            total += row["__size"]
    if not taken:
        return None
    kind = texts.schema["__id"].dataType.simpleString()
    sample = documents.sparkSession.createDataFrame(taken, f"__id {kind}, __label int, __mark long")

    def once(batches):
        seen = set()  # at most the sample: a task sends each text once
        for batch in batches:
            new = []
            for i, name in enumerate(batch.column("__id").to_pylist()):
                if name not in seen:
                    seen.add(name)
                    new.append(i)
            if new:
                yield batch.take(pa.array(new))

    joined = texts.join(F.broadcast(sample), ["__id", "__mark"]).select("__id", "__label", "__text")
    joined = joined.mapInArrow(once, f"__id {kind}, __label int, __text string").dropDuplicates(["__id"])

    def run(batches):
        for batch in batches:
            ids, truth = batch.column("__id"), batch.column("__label")
            table, counts = passages(batch.column("__text").to_pylist())
            ends = np.cumsum(counts)
            blobs = [table[e - c : e].tobytes() for e, c in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays([ids, truth, pa.array(blobs, pa.binary())], ["id", "label", "x"])

    found = joined.mapInArrow(run, f"id {kind}, label int, x binary").toArrow()
    if not found.num_rows:
        return None
    found = found.sort_by([("id", "ascending")])
    blobs = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in found.column("x").to_pylist()]
    truth = np.array(found.column("label").to_pylist(), np.float32)
    return train(np.concatenate(blobs), np.array([len(b) for b in blobs]), truth)


def score(df: DataFrame, model: Attention | None, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1 for each row."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(text).to_pylist()
                found = np.full(len(texts), 0.5) if model is None else model.scores(texts)
                names = [n for n in part.schema.names if n != into]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(found.astype(np.float64))], [*names, into]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != into)
    return df.mapInArrow(run, f"{fields}{', ' if fields else ''}`{into}` double")


def keep_good(df: DataFrame, model: Attention | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose score reaches the threshold, all if nothing could be learnt; same columns."""
    if model is None:
        return df
    return score(df, model, into="__score").filter(F.col("__score") >= threshold).drop("__score")


def digests(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(documents, labels)
    scored = score(documents.select("doc_id", "text"), model).drop("text")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
