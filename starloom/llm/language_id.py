"""Language identification: averaged hashed subword embeddings under a linear softmax.

Byte 3- and 4-grams that stay inside one word (an edge may be the word's border) are hashed to
buckets; a text is the mean of its buckets' vectors, and a linear softmax names the language.
The model is trained by stochastic gradient descent in numpy on a bounded sample of labelled
texts. Part of the sample, and short pieces of it, is kept apart to fit a temperature and the rejection. That is a logistic
model of whether a text is in a learned language at all, from how usual its n-grams are (the mean
log-frequency, in the language where each is most frequent, so texts of two languages pass) and how
many there are. Its positive examples are the texts kept apart and short pieces of them; its
negative ones are the same with the letters of every word shuffled, and the same as they look when
their own language is left out. Since the mean and the softmax's logits are both linear, prediction
adds up one number per n-gram and language, over whole texts.
"""

from __future__ import annotations

import contextlib
import ctypes
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm._common import free_name, table, text_chunks

UNKNOWN = "und"
BUCKETS = 1 << 14
DIMENSIONS = 16
#: Labelled rows for each language that the classifier is fitted on (about so many, chosen by hash).
TRAIN_PER_LANGUAGE = 400
EPOCHS = 12
RATE = 20.0
BATCH = 32
SEED = 7
#: Share of the texts kept apart that the rejection may cost at most.
REJECT_SHARE = 0.001
#: Temperatures that the calibration chooses from.
TEMPERATURES = np.geomspace(0.25, 256, 81)
#: Words of the short pieces at most.
PIECE_WORDS = 12

_SPACE = 32
_FOLD = np.full(256, _SPACE, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _grams(raw: np.ndarray, off: np.ndarray, buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket of the n-gram at every place (``buckets``: none), per n, and where each text begins."""
    rows = len(off) - 1
    starts = off[:-1] + 2 * np.arange(rows)
    buf = np.full(len(raw) + 2 * rows + 4, _SPACE, np.uint8)
    place = np.arange(len(raw)) + np.repeat(2 * np.arange(rows) + 1, np.diff(off))
    buf[place] = _FOLD[raw]
    gap = buf == _SPACE
    n = len(buf) - 4
    code = buf[:n].astype(np.uint32) | (buf[1 : n + 1].astype(np.uint32) << 8) | (buf[2 : n + 2].astype(np.uint32) << 16)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    found = []
    bad = gap[1 : n + 1]
    for size in (3, 4):
        if size == 4:
            code = code | (buf[3 : n + 3].astype(np.uint32) << 24)
            bad = bad | gap[2 : n + 2]
        h = ((code ^ np.uint32(size * 0x9E37)) * np.uint32(2654435761)) >> shift
        found.append(np.where(bad, np.uint32(buckets), h))
    return found, starts


def _bag(raw: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    grams, _ = _grams(raw, np.array([0, len(raw)]), buckets)
    counts = np.bincount(np.concatenate(grams), minlength=buckets + 1)[:buckets]
    ids = np.flatnonzero(counts)
    return ids, counts[ids]


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # languages x (buckets + 1): what one n-gram adds
    bias: np.ndarray
    temperature: float
    usual: np.ndarray  # buckets + 1: log-frequency in the language where it is most frequent
    known: tuple[float, float, float, float]  # constant, weights of usualness and of shortness, least logit accepted

    def scores(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probabilities, one row for each text, and whether it is in one of the languages."""
        grams, starts = _grams(raw, off, self.logits.shape[1] - 1)
        none = self.logits.shape[1] - 1
        count = np.maximum(sum(np.add.reduceat((g != none).astype(np.float64), starts) for g in grams), 1)
        z = np.empty((len(starts), len(self.languages)))
        for k in range(len(self.languages)):
            z[:, k] = sum(np.add.reduceat(self.logits[k][g], starts, dtype=np.float64) for g in grams)
        value = sum(np.add.reduceat(self.usual[g], starts, dtype=np.float64) for g in grams) / count
        return _softmax((z / count[:, None] + self.bias) * self.temperature), self.accepts(value, count)

    def accepts(self, value: np.ndarray, count: np.ndarray) -> np.ndarray:
        constant, usual, short, least = self.known
        return constant + usual * value + short / np.sqrt(count) >= least


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _dense(bags: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> np.ndarray:
    x = np.zeros((len(bags), buckets), np.float32)
    for i, (ids, counts) in enumerate(bags):
        x[i, ids] = counts / max(1, counts.sum())
    return x


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic model with a constant in front, by Newton's method under a slight penalty."""
    middle, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - middle) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + 1e-3 * w
        w -= np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w)), grad)
    slope = w[1:] / scale
    return np.concatenate([[w[0] - slope @ middle], slope])


def _rejection(usual: np.ndarray, bags: list, y: np.ndarray, kinds: np.ndarray) -> tuple[float, float, float, float]:
    """Of languages x buckets log-frequencies and the examples kept apart."""

    def features(ids: np.ndarray, counts: np.ndarray, table: np.ndarray) -> tuple[float, float]:
        n = max(1, counts.sum())
        return float(table[ids] @ counts) / n, 1 / np.sqrt(n)

    best = usual.max(axis=0)
    x, known, whole = [], [], []
    for (ids, counts), label, kind in zip(bags, y, kinds, strict=True):
        x.append(features(ids, counts, best))
        known.append(kind < 2)
        whole.append(kind == 0)
        if kind < 2 and len(usual) > 1:
            x.append(features(ids, counts, np.delete(usual, label, axis=0).max(axis=0)))
            known.append(False)
            whole.append(False)
    x, known, whole = np.array(x), np.array(known), np.array(whole)
    weight = np.where(known, 0.5 / max(1, known.sum()), 0.5 / max(1, (~known).sum())) * len(known)
    w = _logistic(x, known.astype(float), weight)
    logit = w[0] + x @ w[1:]
    least = min(0.0, float(np.quantile(logit[whole], REJECT_SHARE))) if whole.any() else -np.inf
    return (*w.tolist(), least)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], buckets: int = BUCKETS, kinds: list[int] | None = None) -> LanguageModel:
    """Train on bags of buckets. Every fifth text is kept for calibration (none when under ten).

    ``kinds`` says what a bag is: 0 a text, 1 a piece, 2 or 3 the same of shuffled letters; the three
    follow their text and only serve the calibration. Without them no text is rejected.
    """
    kinds = np.zeros(len(labels), int) if kinds is None else np.array(kinds)
    whole = np.flatnonzero(kinds == 0)
    languages = sorted(set(labels))
    never = (0.0, 0.0, 0.0, -np.inf)
    if len(languages) < 2:
        only = np.zeros((len(languages), buckets + 1), np.float32)
        return LanguageModel(languages, only, np.zeros(len(languages)), 1.0, np.zeros(buckets + 1), never)
    y = np.array([languages.index(v) for v in labels])
    rng = np.random.default_rng(SEED)
    order = whole[rng.permutation(len(whole))]
    held = order[: len(order) // 5] if len(order) >= 10 else order
    train = order[len(order) // 5 :] if len(order) >= 10 else order
    weight = len(train) / (len(languages) * np.maximum(1, np.bincount(y[train], minlength=len(languages))))
    emb = rng.normal(0, 0.1, (buckets, DIMENSIONS)).astype(np.float32)
    out = rng.normal(0, 0.5, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    usual = np.full((len(languages), buckets), 0.5)
    for r in train:
        usual[y[r], bags[r][0]] += bags[r][1] / max(1, bags[r][1].sum()) * 1000
    usual = np.log(usual / usual.sum(axis=1, keepdims=True))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        train = rng.permutation(train)
        for i in range(0, len(train), BATCH):
            rows = train[i : i + BATCH]
            x = _dense([bags[r] for r in rows], buckets)
            mean = x @ emb
            p = _softmax(mean @ out + bias).astype(np.float32)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (weight[y[rows]] / len(rows))[:, None].astype(np.float32)
            back = p @ out.T
            out -= 0.05 * rate * (mean.T @ p)
            bias -= 0.01 * rate * p.sum(axis=0)
            emb -= rate * (x.T @ back)
    table_ = np.zeros((len(languages), buckets + 1), np.float32)
    table_[:, :buckets] = (emb @ out).T
    # short pieces are in doubt where whole texts never are
    tried = np.concatenate([held, held + 1]) if len(kinds) > len(whole) else held
    z = np.concatenate([_dense([bags[r] for r in tried[i : i + 256]], buckets) @ table_[:, :buckets].T for i in range(0, len(tried), 256)]) + bias
    at = np.arange(len(tried))
    loss = [-np.log(np.maximum(_softmax(z * t)[at, y[tried]], 1e-12)).mean() for t in TEMPERATURES]
    temperature = float(TEMPERATURES[int(np.argmin(loss))])
    near = np.concatenate([held + k for k in range(4)]) if len(kinds) > len(whole) else np.empty(0, int)
    known = _rejection(usual, [bags[r] for r in near], y[near], kinds[near]) if len(near) else never
    return LanguageModel(languages, table_, bias.astype(np.float64), temperature, np.append(usual.max(axis=0), 0.0), known)


def _examples(text: bytes) -> list[bytes]:
    """The text, a short piece of it, and both with the letters of every word shuffled; chosen by the text itself."""
    words = text.decode().split()
    rng = np.random.default_rng(xxhash.xxh64_intdigest(text, SEED))
    size = int(rng.integers(1, PIECE_WORDS + 1))
    at = int(rng.integers(0, max(1, len(words) - size + 1)))
    shuffled = ["".join(np.array(list(w))[rng.permutation(len(w))]) for w in words]
    return [text, *[" ".join(w).encode() for w in (words[at : at + size], shuffled, shuffled[at : at + size])]]


def _give_back() -> None:
    """Return free memory to the system: the process would hold what a fit took, and more after each fit, for as long as it lives."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems' allocators return it themselves
        ctypes.CDLL(None).malloc_trim(0)


def train(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, buckets: int = BUCKETS) -> LanguageModel:
    """Fit a model on ``text`` and non-null ``lang`` of ``docs``, about ``per_language`` different texts of each at most.

    Texts are chosen by their hash and copies count once, in the sample and in the number that it is
    drawn from, so that no group of copies fills or empties it.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")).collect()}
    if not counts:
        return fit([], [], buckets)
    spark = docs.sparkSession
    share = spark.createDataFrame([(k, min(1.0, per_language / max(1, n))) for k, n in counts.items()], "lang string, share double")
    chosen = rows.join(F.broadcast(share), "lang").where((F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30)) < F.col("share")).select("lang", "text").distinct()

    def bags(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = [_bag(np.frombuffer(x, np.uint8), buckets) for x in _examples(batch.column("text")[i].as_py().encode())]
                lists = [pa.array([f[k].astype(np.int32) for f in found], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("lang")[i].as_py()] * 4), pa.array([xxhash.xxh128_digest(batch.column("text")[i].as_py())] * 4, pa.binary()), pa.array(range(4), pa.int32()), *lists], ["lang", "name", "kind", "ids", "counts"])

    def fitted(batches):
        if not (held := list(batches)):
            return
        got = pa.Table.from_batches(held)
        found = [(np.asarray(a.values), np.asarray(b.values)) for a, b in zip(got.column("ids").combine_chunks(), got.column("counts").combine_chunks(), strict=True)]
        labels, names, kinds = (got.column(c).to_pylist() for c in ("lang", "name", "kind"))
        order = sorted(range(len(labels)), key=lambda k: (labels[k], names[k], kinds[k]))
        model = fit([found[k] for k in order], [labels[k] for k in order], buckets, [kinds[k] for k in order])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
        del held, got, found, labels, names, kinds, order, model
        _give_back()

    # The bounded sample goes to one task, so that the driver holds no more than the model.
    got = chosen.mapInArrow(bags, "lang string, name binary, kind int, ids array<int>, counts array<int>").repartition(1).mapInArrow(fitted, "model binary").first()
    return pickle.loads(got["model"]) if got else fit([], [], buckets)


def predict(docs: DataFrame, model: LanguageModel, keep_text: bool = False) -> DataFrame:
    """``docs``, without ``text`` unless ``keep_text``, plus ``lang_pred``, ``score`` (0 to 1) and ``accepted``.

    A null text, or one without any letter, is ``und`` with score 0 and is not accepted; so is
    everything when no language was learned. A text that seems to be in none of the languages is not
    accepted, whatever its score among them. Other columns pass through, whatever their names,
    except that these three replace columns of the same name. Texts are read whole.
    """
    names = [c for c in docs.columns if c not in ("text", "lang_pred", "score", "accepted")]
    lettered = free_name(docs.columns, "lettered")
    rows = docs.select(*[F.col(f"`{c}`") for c in names], "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(lettered))
    names += ["text"] * keep_text
    kept = rows.select(*[F.col(f"`{c}`") for c in names])
    schema = kept.schema.add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            letters = batch.column(lettered).to_numpy(zero_copy_only=False).astype(bool)
            best, score, known = np.full(batch.num_rows, -1), np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            if m.languages:
                for i, j, raw, off in text_chunks(batch.column("text")):
                    p, known[i:j] = m.scores(raw, off)
                    best[i:j], score[i:j] = p.argmax(axis=1), p.max(axis=1)
            best[~letters], score[~letters] = -1, 0.0
            said = pa.array([m.languages[k] if k >= 0 else UNKNOWN for k in best], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], said, pa.array(score), pa.array((best >= 0) & known)], [*names, "lang_pred", "score", "accepted"])

    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """The fold that training never sees: crc32 of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(docs.where(~F.col("held_out")).select("text", "lang"))
    return predict(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score", "accepted")
