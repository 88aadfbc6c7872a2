"""Operator 3, toxicity: a subsequence string-kernel SVM with Nystroem landmarks.

Two words are alike as far as they share subsequences of three characters, weighted down by the length of the stretch they span
(``DECAY`` per character, at most ``SPAN``), so letters put in between or left out cost little. Word ends are characters of their own. The kernel
of two sentences sums that of their words where it exceeds ``FLOOR``. Landmarks are words that mark toxic training documents, and the clean
words most like them; sentences are mapped onto them (Nystroem) and a linear SVM with squared hinge loss is trained. Training sentences
come from labelled documents: those of clean documents are negative; of each toxic document those with a strongly marked word are positive, and the most toxic one, chosen anew
after each fit. A document scores by its most toxic sentence, turned into a probability by Platt's scaling.

Scale: one map pass without a shuffle; a word's contribution is computed once per worker while it stays in a bounded memo. The word statistics that choose the landmarks count
all labelled documents that are not held out: up to ``SHIPPED`` labelled ids, counted first, are broadcast to the texts; beyond that, the texts that a bit map
of labelled ids lets through are shuffled once. Of the words the driver gets the words with the highest ranks. The SVM and Platt's scaling use at
most ``FIT_DOCS`` toxic and twice as many clean labelled documents, those with the smallest hash of doc_id; of texts only theirs reach the driver, so its memory hangs on their lengths.

Defined cases: a NULL or empty text has no sentence, and the score of one without any word like a landmark. Texts are read whole; a word of more than
``WORD`` characters is read in overlapping stretches. Repeated rows score alike, an empty table gives no rows, further columns are not
read. A NULL doc_id is not held out. Labels that are NULL are left out; contradicting ones count as toxic; without both classes every score is 0.0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.steps import maybe_of, release, written
from cohortsieve.llm.texts import table, text_of

FOLDS = 5
FIT_DOCS = 800
DECAY, SPAN, FLOOR = 0.7, 5, 0.3
TOXIC_LANDMARKS, CLEAN_LANDMARKS, GROUPS = 96, 96, 16
CLEAN_WORDS = 30_000
ROUNDS, RIDGE, STRONG = 3, 1e-6, 3.0
WORD, MEMO = 32, 600_000
#: The most labelled ids that are broadcast.
SHIPPED = 500_000
_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n+")
_SPELT = re.compile(r"(?<!\S)(?:\w[^\w\s]?[ \t]){2,}\w(?!\S)")
_SIGN = re.compile(r"[\W_]+")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
#: Digits and signs that stand for letters inside a word (fixed values).
_LIKE = str.maketrans("013457@$", "oieastas")


def sentences(text: str) -> list[list[str]]:
    """Lower-cased raw words per sentence; letters that are spelt apart also as one word."""
    out = []
    for s in _SENTENCE.split(text.lower()):
        words = s.split()
        if words:
            words += [re.sub(r"\W", "", m) for m in _SPELT.findall(s)]
            out.append(words)
    return out


def stretches(raw: str) -> list[str]:
    """A raw word without signs at its ends, in pieces the kernel reads."""
    w = raw
    if not raw.isalpha():
        w = _EDGE.sub("", raw)
        if any(c.isalpha() for c in w):
            w = _SIGN.sub("", w.translate(_LIKE))
    return [w] if len(w) <= WORD else [w[i:i + WORD] for i in range(0, len(w) - WORD // 4, WORD - WORD // 4)]


def _codes(words: list[str], size: int) -> np.ndarray:
    """Character codes below 64 of words of one length, with the ends marked."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), size).astype(np.int64)
    letters, digits = (points >= 97) & (points <= 122), (points >= 48) & (points <= 57)
    codes = np.where(letters, points - 96, np.where(digits, points - 48 + 27, np.where(points < 128, 39, 40 + points % 24)))
    ends = np.ones((len(words), 1), np.int64)
    return np.concatenate((37 * ends, codes, 38 * ends), axis=1)


_PLACES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All increasing triples of places within a stretch of SPAN, and their weights."""
    if n not in _PLACES:
        at = [(i, j, k) for i in range(n) for j in range(i + 1, min(n, i + SPAN)) for k in range(j + 1, min(n, i + SPAN))]
        p = np.array(at, np.int64).reshape(-1, 3)
        _PLACES[n] = p, DECAY ** (p[:, 2] - p[:, 0] - 2.0) if len(p) else np.zeros(0)
    return _PLACES[n]


def triples(words: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """For words of one length: the triple at each choice of places, and the weights of the choices."""
    codes = _codes(words, size)
    p, w = _places(size + 2)
    return (codes[:, p[:, 0]] << 12) | (codes[:, p[:, 1]] << 6) | codes[:, p[:, 2]], w


def _norms(ids: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Lengths of words' vectors; equal triples of a word add up."""
    keys = ids + (np.arange(len(ids)) << 18)[:, None]
    order = np.argsort(keys, axis=1)
    flat, weights = np.take_along_axis(keys, order, 1).ravel(), w[order].ravel()
    starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    return np.sqrt(np.bincount(flat[starts] >> 18, np.add.reduceat(weights, starts) ** 2, len(ids)))


class Kernel:
    """The kernel between any words and fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks, vectors = landmarks, []
        for word in landmarks:
            ids, w = triples([word], len(word))
            t, where = np.unique(ids[0], return_inverse=True)
            v = np.bincount(where, w)
            vectors.append((t, v / np.sqrt((v ** 2).sum())))
        known = np.unique(np.concatenate([t for t, _ in vectors]))
        self.row = np.zeros(1 << 18, np.int32)
        self.row[known] = np.arange(1, len(known) + 1)
        self.weights = np.zeros((len(known) + 1, len(landmarks)), np.float32)
        for m, (t, v) in enumerate(vectors):
            self.weights[self.row[t], m] = v
        # Landmarks in groups of like ones: a word is far from all of a group if it is far from their maximum.
        own = self.weights.T @ self.weights
        groups: list[list[int]] = []
        for m in range(len(landmarks)):
            best = max(groups, key=lambda g: own[m, g[0]], default=None)
            if best is None or (own[m, best[0]] < 0.3 and len(groups) < GROUPS):
                groups.append([m])
            else:
                best.append(m)
        self.most = np.stack([self.weights[:, g].max(1) for g in groups], 1)

    def __call__(self, words: list[str]) -> np.ndarray:
        """(word, landmark), from 0 to 1, and 0 up to FLOOR."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        sizes: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > 1:
                sizes.setdefault(len(w), []).append(i)
        for size, which in sizes.items():
            for a in range(0, len(which), 4096):
                part = which[a:a + 4096]
                ids, w = triples([words[i] for i in part], size)
                w32, rows = w.astype(np.float32), self.row[ids]
                # No landmark can be nearer than this, as equal triples only lengthen a vector.
                bound = np.tensordot(self.most[rows], w32, ([1], [0])).max(1) if len(w) else np.zeros(len(part))
                likely = np.flatnonzero(bound > FLOOR * np.sqrt((w ** 2).sum()))
                for b in range(0, len(likely), 256):
                    some = likely[b:b + 256]
                    near = np.tensordot(self.weights[rows[some]], w32, ([1], [0])) / _norms(ids[some], w)[:, None]
                    out[np.array(part)[some]] = np.maximum(near - FLOOR, 0) / (1 - FLOOR)
        return out


@dataclass
class ToxicModel:
    landmarks: list[str]
    alpha: np.ndarray
    bias: float
    slope: float
    offset: float


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise ridge and weighted squared hinge, by Newton steps."""
    v = np.zeros(x.shape[1] + 1)
    ridge = RIDGE * c.sum() * np.append(np.ones(x.shape[1]), 1e-6)
    for _ in range(30):
        gradient, hessian = ridge * v, np.diag(ridge) + 1e-9 * np.eye(len(v))
        for at in range(0, len(x), 4096):
            rows = np.concatenate((x[at:at + 4096], np.ones((len(x[at:at + 4096]), 1))), 1).astype(np.float64)
            margin = 1 - y[at:at + 4096] * (rows @ v)
            on = margin > 0
            a, cw = rows[on], c[at:at + 4096][on]
            gradient = gradient - 2 * (a.T @ (cw * y[at:at + 4096][on] * margin[on]))
            hessian = hessian + 2 * (a.T * cw) @ a
        step = np.linalg.solve(hessian, gradient)
        v = v - step
        if np.abs(step).max() < 1e-6:
            break
    return v[:-1], float(v[-1])


def _platt(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over decision values."""
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    t, ab, x = np.where(y == 1, high, low), np.array([1.0, 0.0]), np.stack((f, np.ones(len(f))), 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        h = (x.T * np.maximum(p * (1 - p), 1e-9)) @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - t))
        size = 1.0
        loss = lambda v: np.logaddexp(0, x @ v).sum() - (t * (x @ v)).sum()
        while size > 1e-4 and loss(ab - size * step) > loss(ab):
            size /= 2
        ab = ab - size * step
        if np.abs(step).max() < 1e-7:
            break
    return float(ab[0]), float(ab[1])


def words_of_text(text: str) -> set[str]:
    """The words of a text that may become landmarks."""
    return {p for s in sentences(text) for raw in s for p in stretches(raw) if len(p) > 2}


@dataclass(frozen=True)
class WordStatistics:
    """Marked words with their log-odds, the most marking first, and common clean words, the most frequent first."""

    odds: dict[str, float]
    clean: list[str]


def log_odds(toxic, clean, n_toxic, n_clean, log=np.log):
    """Of a word in ``toxic`` and ``clean`` documents out of so many, shrunk towards none for rare words; numbers or Columns."""
    return log((toxic + 0.05) / n_toxic) - log((clean + 0.5) / n_clean)


def word_statistics(docs: DataFrame, known: DataFrame) -> WordStatistics | None:
    """Document frequencies per label over all labelled documents of ``known`` (doc_id, toxic); None without both labels.

    Words are counted per task first. The driver gets ``TOXIC_LANDMARKS`` marked words and ``CLEAN_WORDS`` clean ones.
    """
    size = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(size) != {0, 1}:
        return None

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        for b in batches:
            for text, label in zip(b.column("text"), b.column("toxic").to_pylist()):
                for w in words_of_text(text.as_py()):
                    held.setdefault(w, [0, 0])[label] += 1
            if len(held) > MEMO:
                yield _counted(held)
                held = {}
        yield _counted(held)

    def _counted(held: dict[str, list[int]]) -> pa.RecordBatch:
        return pa.record_batch({"w": pa.array(list(held), pa.string()), "clean": pa.array([c for c, _ in held.values()], pa.int64()),
                                "toxic": pa.array([t for _, t in held.values()], pa.int64())})

    rows = docs.select("doc_id", text_of().alias("text"))
    few = size[0] + size[1] <= SHIPPED
    labelled = (rows.join(F.broadcast(known), "doc_id") if few else rows.filter(maybe_of("doc_id", known)).join(known, "doc_id")).select("text", "toxic")
    counts = written(labelled.mapInArrow(per_task, "w string, clean long, toxic long").groupBy("w").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "word-counts")
    odds = log_odds(F.col("toxic"), F.col("clean"), F.lit(float(size[1])), F.lit(float(size[0])), F.log)
    marked = counts.filter("toxic >= 2").withColumn("odds", odds).orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "w").limit(TOXIC_LANDMARKS).collect()
    clean = counts.filter((F.col("toxic") == 0) | ((F.col("toxic") >= 2) & (odds < 0))).filter("clean > 0") \
        .orderBy(F.desc("clean"), "w").limit(CLEAN_WORDS).collect()
    release(counts)
    return WordStatistics({r["w"]: r["odds"] for r in marked}, [r["w"] for r in clean])


def train(texts: list[str], toxic: list[int], statistics: WordStatistics | None) -> ToxicModel | None:
    """A model from labelled texts and the words' statistics, or None without both classes."""
    y = np.array(toxic)
    if not len(y) or y.min() == y.max() or statistics is None or not statistics.odds:
        return None
    one: dict[str, str] = {}  # equal words share one object
    docs = [[[one.setdefault(p, p) for raw in s for p in stretches(raw)] for s in sentences(t)] for t in texts]
    odds, marked, clean = statistics.odds, list(statistics.odds), statistics.clean
    near = Kernel(marked)(clean)
    # The clean words nearest to each marked word in turn, so that every family has its counterweight.
    ranked = np.argsort(-near, axis=0, kind="stable")[:8]
    nearest = dict.fromkeys(i for row in ranked.tolist() for m, i in enumerate(row) if near[i, m] > 0)
    landmarks = marked + [clean[i] for i in list(nearest)[:CLEAN_LANDMARKS]]
    kernel = Kernel(landmarks)
    # Of all words only those near a landmark matter; the others are never held as rows.
    words, at, found = sorted(one), {}, []
    for a in range(0, len(words), 20_000):
        block = kernel(words[a:a + 20_000])
        near_one = np.flatnonzero(block.any(1))
        at |= {words[a + i]: len(at) + n for n, i in enumerate(near_one.tolist())}
        found.append(block[near_one])
    k = np.concatenate(found) if found else np.zeros((0, len(landmarks)), np.float32)
    # Nystroem: landmarks' own kernel, with eigenvalues that the floor made negative or tiny left out.
    value, vector = np.linalg.eigh((lambda a: (a + a.T) / 2)(kernel(landmarks).astype(np.float64)))
    keep = value > 1e-3 * value.max()
    to = (vector[:, keep] / np.sqrt(value[keep])).astype(np.float32)
    # What a marked word adds when a letter is put in, so that the fit learns to tolerate it.
    marks = {w for w in marked if odds[w] > STRONG}
    bent = {w: kernel([w[:i] + c + w[i:] for i in range(2, len(w), 2) for c in "xu"]) @ to for w in marked}
    rows, owner, has_mark, extra, empty = [], [], [], [], np.zeros(len(docs), int)
    for i, d in enumerate(docs):
        for s in d:
            used = [at[w] for w in s if w in at]
            if used:
                rows.append(k[used].sum(0) @ to)
                owner.append(i)
                has_mark.append(not marks.isdisjoint(s))
                for w in marks.intersection(s) if y[i] else ():
                    own = rows[-1] - k[at[w]] @ to if w in at else rows[-1]
                    extra.append(own + bent[w][len(extra) % len(bent[w])] if len(bent[w]) else rows[-1])
            else:
                empty[i] += 1
    if not rows:
        return None
    x, owner = np.array(rows), np.array(owner)
    bent_rows = np.array(extra, np.float32).reshape(-1, x.shape[1])
    del rows, extra, one
    is_toxic = y[owner] == 1
    v, b = x[is_toxic].mean(0) - (x[~is_toxic].mean(0) if (~is_toxic).any() else 0), 0.0
    quiet = np.concatenate((x, np.zeros((1, x.shape[1]), x.dtype)))
    for _ in range(ROUNDS):
        f = x @ v + b
        top = np.full(len(docs), -np.inf)
        np.maximum.at(top, owner, f)
        chosen = is_toxic & ((f == top[owner]) & (f > b) | np.array(has_mark))
        use = np.append(chosen | ~is_toxic, True)
        label = np.where(np.append(chosen, False), 1.0, -1.0)[use]
        n_negative = empty[y == 0].sum() + (~is_toxic).sum()
        weight = np.append(np.ones(len(x)), max(1, empty[y == 0].sum()))
        weight[:-1][chosen] = max(1.0, n_negative / (40 * max(1, chosen.sum())))
        heavy = np.full(len(bent_rows), weight[:-1][chosen].max() if chosen.any() else 1.0)
        v, b = _svm(np.concatenate((quiet[use], bent_rows)), np.append(label, np.ones(len(bent_rows))),
                    np.append(weight[use], heavy))
    top = np.full(len(docs), b)
    np.maximum.at(top, owner, x @ v + b)
    slope, offset = _platt(top, y.astype(float))
    return ToxicModel(landmarks, to @ v, b, slope, offset)


class Scorer:
    def __init__(self, model: ToxicModel):
        self.model, self.kernel = model, Kernel(model.landmarks)
        self.known: dict[str, float] = {}

    def score(self, texts: list[str]) -> np.ndarray:
        """The probability of each text to be toxic."""
        m = self.model
        split = [sentences(t) for t in texts]
        new = list({w for t in split for s in t for w in s} - self.known.keys())
        parts = [stretches(w) for w in new]
        flat = list({p for ps in parts for p in ps})
        found = {}
        for a in range(0, len(flat), 50_000):
            block = flat[a:a + 50_000]
            found.update(zip(block, (self.kernel(block) @ m.alpha).tolist()))
        if len(self.known) + len(new) > MEMO:
            needed = {w for t in split for s in t for w in s}
            self.known = {w: f for w, f in self.known.items() if w in needed}
        self.known.update((w, sum(found[p] for p in ps)) for w, ps in zip(new, parts))
        of = self.known.__getitem__
        f = np.array([max((sum(map(of, s)) for s in t), default=0.0) for t in split]) + m.bias
        if len(self.known) > MEMO:
            self.known = {}
        return 1 / (1 + np.exp(-np.clip(m.slope * f + m.offset, -500, 500)))




def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel | None:
    """A model from labelled documents that are not held out."""
    known = written(labels.filter(~held_out()).filter("doc_id is not null and toxic is not null")
                    .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")), "toxic-labels")
    order = (F.xxhash64("doc_id"), "doc_id")
    sample = known.filter("toxic = 1").orderBy(*order).limit(FIT_DOCS).unionAll(
        known.filter("toxic = 0").orderBy(*order).limit(2 * FIT_DOCS))
    rows = (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id")
            .dropDuplicates(["doc_id", "text"]).toPandas().sort_values(["doc_id", "text"]))
    model = train(rows["text"].tolist(), rows["toxic"].tolist(), word_statistics(docs, known))
    release(known)
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel | None) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per row of ``docs``."""
    rows = docs.select("doc_id", held_out().alias("held_out"), text_of().alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for b in batches:
            texts, scores = b.column("text"), []
            for a in range(0, len(texts), 1000):
                scores.append(scorer.score(texts.slice(a, 1000).to_pylist()))
            yield pa.record_batch({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"),
                                   "score": pa.array(np.concatenate(scores) if scores else np.zeros(0))})

    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    return rows.mapInArrow(per_batch, kind).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_toxicity(docs, fit(docs, table(spark, folder, "labels")))
