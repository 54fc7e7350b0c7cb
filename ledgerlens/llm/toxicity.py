"""Toxicity by a convolutional text classifier in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first bytes (so inflected forms share a part). Filters of several
widths slide over the whole text, each is pooled by its maximum, and a logistic layer gives a probability. It is trained by gradient descent
(Adagrad) on balanced batches, each without some of its words; rows of the embedding table that fewer than ``LEAST_TEXTS`` training texts used
are zero, so words that the fit hardly saw say nothing.

Thresholds are calibrated by language on all labelled rows of a fold that the fit did not see, whatever their number and length: these are
scored like any other, and counts by language, label and one of ``BINS`` equal stretches of the probability give the threshold. The language
is guessed from the text alone, by its function words. A score maps the probability so that the threshold of the language lies at ``CUT``.

Only the fit takes a bounded sample: at most ``FIT_ROWS`` labelled texts of each class, of at most ``FIT_BYTES`` bytes and ``FIT_WORDS`` words
(cut as the classifier cuts them), drawn by a hash, one for each ``doc_id``, so the driver holds at most 72 MB of texts. Scoring reads every whole text.

Defined results: a null or empty text gets the score of no words; rows with the same ``doc_id`` are scored one by one; a null ``doc_id`` is not held
out; labels that are null, or of a ``doc_id`` that has several different ones, are not used; without labels of both classes every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, table
from ledgerlens.llm.wordhash import chunks, word_hashes
from ledgerlens.llm.words import words

#: Rows of the embedding table, length of a vector, filter widths, filters of each width, bytes of a word's head.
ROWS, SIZE, WIDTHS, FILTERS, HEADS = 1 << 16, 16, (1, 2, 3), 4, (4, 5)
#: Bounds of the sample, batches and their size, learning rate.
FIT_ROWS, FIT_WORDS, FIT_BYTES, BATCHES, BATCH, RATE = 1500, 1500, 24_000, 500, 32, 0.15
#: Training texts that must use a row of the table, share of the words in a batch.
LEAST_TEXTS, KEPT_WORDS = 2, 0.5
#: Score from which a text counts as toxic.
CUT = 0.3
#: Positive rows below which a language takes the threshold of all languages.
LEAST_POSITIVE = 20
#: Equal stretches of the probability in which labelled rows are counted.
BINS = 1 << 14

# Function words by which a language is guessed.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was with on as by he at be this",
    "de": "der die und das den mit ist von zu ein eine dem nicht auf für sich des im",
    "fr": "le la les des et que en un une est dans pour qui sur par au du il",
    "es": "el los las de y que en un por con para una del se su no al lo",
}

#: Separators: ASCII characters but letters and digits.
_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Model:
    embedding: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: dict[str, float]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of each word (one column for the word and each head), words of each text, and the 64-bit word hashes."""
    hashes, counts, *heads = word_hashes(texts, _BREAK, HEADS)
    salted = [(h >> np.uint64(7 * k)) % np.uint64(ROWS) for k, h in enumerate([hashes, *heads])]
    return np.stack(salted, axis=1).astype(np.int32), counts, hashes


def _language_hashes() -> dict[str, np.ndarray]:
    return {lang: np.sort(word_hashes([w.encode()], _BREAK)[0]) for lang, w in FUNCTION_WORDS.items()}


def languages(hashes: np.ndarray, counts: np.ndarray) -> list[str]:
    """For each text the language with most function words; ``""`` without any."""
    names, edges = list(FUNCTION_WORDS), np.concatenate([[0], np.cumsum(counts)])
    found = []
    for known in _language_hashes().values():
        hit = np.concatenate([[0], np.cumsum(np.isin(hashes, known))])
        found.append(hit[edges[1:]] - hit[edges[:-1]])
    table = np.array(found).T
    return [names[k] if row[k] else "" for row, k in zip(table, table.argmax(1) if len(table) else [], strict=True)]


def _padded(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words when each text is followed by the widest filter's overhang; and where each text begins."""
    gap = max(WIDTHS)
    starts = np.concatenate([[0], np.cumsum(counts + gap)])
    place = np.arange(len(rows)) + np.repeat(np.arange(len(counts)) * gap, counts)
    return place, starts


def _vectors(embedding: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place, starts = _padded(rows, counts)
    out = np.zeros((int(starts[-1]) + max(WIDTHS), embedding.shape[1]), dtype=np.float32)
    if len(rows):
        out[place] = embedding[rows].sum(1)
    return out, starts


def _convolved(vectors: np.ndarray, n: int, kernel: np.ndarray) -> np.ndarray:
    return sum(vectors[j : n + j] @ kernel[j] for j in range(len(kernel)))


def probabilities(model: Model, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each text, in stretches of bounded memory; a text of any length is pooled whole."""
    out = np.empty(len(counts))
    first, at = 0, 0
    while first < len(counts):
        last, size = first, 0
        while last < len(counts) and (last == first or size + counts[last] <= 1 << 15):
            size += counts[last]
            last += 1
        vectors, starts = _vectors(model.embedding, rows[at : at + size], counts[first:last])
        n = int(starts[-1])
        pooled = [np.maximum(np.maximum.reduceat(_convolved(vectors, n, k), starts[:-1], axis=0) + b, 0) for k, b in zip(model.kernels, model.biases, strict=True)]
        out[first:last] = 1 / (1 + np.exp(-np.clip(np.concatenate(pooled, axis=1) @ model.weights + model.bias, -30, 30)))
        first, at = last, at + size
    return out


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Train on texts given as table rows of their words."""
    rng = np.random.default_rng(seed)
    held = np.zeros(ROWS, dtype=np.int64)
    for t in texts:
        held[np.unique(t)] += 1
    common = held >= LEAST_TEXTS
    embedding = (rng.normal(0, 0.1, (ROWS, SIZE)) * common[:, None]).astype(np.float32)
    kernels = [rng.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    biases = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
    weights, bias = rng.normal(0, 0.3, FILTERS * len(WIDTHS)), 0.0
    seen = [np.full_like(x, 1e-2) for x in (embedding, *kernels, *biases, weights)]
    classes = [np.flatnonzero(labels == k) for k in (0, 1)]
    for _ in range(BATCHES):
        batch = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])
        # some words are left out each time, so that no single one of a text carries its label
        thinned = [texts[i][rng.random(len(texts[i])) < KEPT_WORDS] for i in batch]
        counts, rows = np.array([len(t) for t in thinned]), np.concatenate(thinned)
        vectors, starts = _vectors(embedding, rows, counts)
        n, pooled, chosen = int(starts[-1]), [], []
        for kernel in kernels:
            wide = _convolved(vectors, n, kernel)
            best = np.array([a + wide[a:b].argmax(0) for a, b in zip(starts[:-1], starts[1:], strict=True)])
            chosen.append(best)
            pooled.append(np.take_along_axis(wide, best, 0))
        raw = np.concatenate([p + b for p, b in zip(pooled, biases, strict=True)], axis=1)
        active = np.maximum(raw, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ weights + bias, -30, 30)))
        error = (p - labels[batch]) / len(batch)
        back = np.outer(error, weights) * (raw > 0)
        d_weights, bias = active.T @ error + 1e-4 * weights, bias - RATE * error.sum()
        owner = np.full(n + max(WIDTHS), -1)
        owner[_padded(rows, counts)[0]] = np.arange(len(rows))
        d_embedding = np.zeros_like(embedding)
        d_kernels, d_biases = [], []
        for w, (kernel, best) in enumerate(zip(kernels, chosen, strict=True)):
            g = back[:, w * FILTERS : (w + 1) * FILTERS]
            d_kernel = np.zeros_like(kernel)
            for j in range(len(kernel)):
                at = best + j
                d_kernel[j] = np.einsum("bfs,bf->sf", vectors[at], g)
                word = owner[at]
                push = g[:, :, None] * kernel[j].T[None]
                real = word >= 0
                for column in range(rows.shape[1]):
                    np.add.at(d_embedding, rows[word[real], column], push[real])
            d_kernels.append(d_kernel)
            d_biases.append(g.sum(0))
        for value, gradient, total in zip((embedding, *kernels, *biases, weights), (d_embedding, *d_kernels, *d_biases, d_weights), seen, strict=True):
            touched = np.flatnonzero(gradient.any(axis=1) & common) if value is embedding else slice(None)
            total[touched] += gradient[touched] ** 2
            value[touched] -= RATE * gradient[touched] / np.sqrt(total[touched])
    return Model(embedding, kernels, biases, weights, bias, {"": 0.5})


def best_threshold(p: np.ndarray, positive: np.ndarray, rows: np.ndarray) -> float:
    """Middle of the gap at which the F1 value is greatest, from the positive and all rows at each distinct probability."""
    order = np.argsort(-p, kind="stable")
    f1 = 2 * np.cumsum(positive[order]) / (np.cumsum(rows[order]) + positive.sum())
    sorted_p = p[order]
    k = int(f1.argmax())
    below = sorted_p[k + 1] if k + 1 < len(p) else 0.0
    return float(np.clip((sorted_p[k] + below) / 2, 0.3, 0.99))


def calibrated(p: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Probabilities moved so that the threshold lies at ``CUT``; still 0 to 1 and in the same order."""
    return np.where(p < thresholds, CUT * p / thresholds, CUT + (1 - CUT) * (p - thresholds) / (1 - thresholds))


def _fold() -> Column:
    """Two folds to fit, the third held out, the fourth to calibrate."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))


def _sample(docs: DataFrame, labelled: DataFrame) -> list:
    """Bounded draw of labelled texts: for each class the ids that come first by a hash; then one text of each.

    Only ids are joined and sorted; those drawn are few enough to broadcast, so only the texts drawn are shuffled.
    """
    drawn = []
    for label in (0, 1):
        own = labelled.filter(F.col("toxic") == label)
        drawn += own.orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(FIT_ROWS).collect()
    if not drawn:
        return []
    wanted = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in drawn], "doc_id long, toxic int")
    few = (F.octet_length("text") <= FIT_BYTES) & (F.size(words(F.col("text"))) <= FIT_WORDS)
    found = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").filter(few)
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()


def _counted(docs: DataFrame, one: DataFrame, model: Model) -> list:
    """``language, bin, toxic, n`` over all rows of ``docs`` with a label. Texts are scored where they lie; only ids and bins are shuffled."""
    rated = score(docs.select("doc_id", "text"), model, ["doc_id"])
    place = F.least(F.floor(F.col("probability") * BINS), F.lit(BINS - 1)).alias("bin")
    each = rated.groupBy("doc_id", "language", place).agg(F.count("*").alias("n"))
    return each.join(one, "doc_id").groupBy("language", "bin", "toxic").agg(F.sum("n").alias("n")).collect()


def _thresholds(counts: list) -> dict[str, float]:
    """By language, and under ``""`` that of all rows."""
    spoken, place, n = np.array([r["language"] for r in counts]), np.array([r["bin"] for r in counts]), np.array([r["n"] for r in counts])
    toxic, found = np.array([r["toxic"] for r in counts]) == 1, {}
    for lang in ["", *FUNCTION_WORDS]:
        own = spoken == lang if lang else np.ones(len(n), dtype=bool)
        if lang and (n[own & toxic].sum() < LEAST_POSITIVE or not (own & ~toxic).any()):
            continue
        rows, positive = (np.bincount(place[k], n[k], BINS) for k in (own, own & toxic))
        held = np.flatnonzero(rows)
        found[lang] = best_threshold((held + 0.5) / BINS, positive[held], rows[held])
    return found


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit and calibrate on ``doc_id, text`` and ``doc_id, toxic``; the third of four folds is never looked at."""
    one = labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").select("doc_id", "toxic")
    rows = _sample(docs, docs.select("doc_id").filter(_fold() < 2).distinct().join(one, "doc_id"))
    marks = np.array([r["toxic"] for r in rows])
    if len(set(marks.tolist())) < 2:
        return None
    # in stretches, so that the driver holds table rows and not the intermediate arrays of all texts
    got, counts = [], []
    for _, raw in chunks([r["text"] for r in rows]):
        own, words, _ = features(raw)
        got.append(own)
        counts.append(words)
    model = fit(np.split(np.concatenate(got), np.cumsum(np.concatenate(counts))[:-1]), marks)
    counted = _counted(docs.filter(_fold() == 3), one, model)
    if len({r["toxic"] for r in counted}) < 2:
        counted = _counted(docs.filter(_fold() < 2), one, model)
    model.thresholds = _thresholds(counted)
    return model


def score(docs: DataFrame, model: Model | None, kept: list[str] | None = None) -> DataFrame:
    """The documents with ``probability``, ``language`` (guessed) and ``score``; taken names get a leading underscore. ``kept``: columns that go on."""
    kept = docs.columns if kept is None else kept
    names = [fresh(docs, n) for n in ("probability", "language", "score")]
    if model is None:
        return docs.select(*kept).withColumns(dict(zip(names, (F.lit(0.0), F.lit(""), F.lit(0.0)), strict=True)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, going = docs.columns.index("text"), [docs.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            p, said = [], []
            for _, raw in chunks(batch.column(at).to_pylist()):
                rows, counts, hashes = features(raw)
                p.append(probabilities(known, rows, counts))
                said += languages(hashes, counts)
            got = np.concatenate(p) if p else np.empty(0)
            cuts = np.array([known.thresholds.get(s, known.thresholds[""]) for s in said])
            columns = [pa.array(got), pa.array(said, pa.string()), pa.array(calibrated(got, cuts) if len(got) else got)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in going], *columns], [*kept, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in (docs.schema[c] for c in kept)] + [f"`{n}` {t}" for n, t in zip(names, ("double", "string", "double"), strict=True)])
    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below ``CUT``, columns as they came."""
    scored = score(docs, train(docs, labels))
    return scored.filter(F.col(scored.columns[-1]) < CUT).select(*docs.columns)


def op4_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "probability", "language")
