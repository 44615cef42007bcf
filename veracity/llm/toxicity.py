"""Toxicity (2): a linear-chain conditional random field over words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT = r"[^\p{L}\p{N}_']+"
#: Buckets of the feature hash.
FEATURES = 1 << 20
#: Words of a segment: segments of all texts advance together.
SEGMENT = 256
PREFIXES = (2, 3, 4, 5)


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words of a batch: code of each, number per text, and the distinct words."""
    parts = pc.split_pattern_regex(pc.fill_null(texts, ""), SPLIT)
    parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
    coded = parts.values.dictionary_encode()
    n = np.diff(parts.offsets.to_numpy()).astype(np.int64)
    codes = coded.indices.to_numpy().astype(np.int64)[parts.offsets[0].as_py():parts.offsets[-1].as_py()]
    spelled = coded.dictionary.to_pylist()
    if "" in spelled:  # before the first or after the last word
        full = codes != spelled.index("")
        n = np.bincount(np.repeat(np.arange(len(n)), n)[full], minlength=len(n)).astype(np.int64)
        codes = codes[full]
    return codes, n, spelled


def names(word: str) -> list[str]:
    """Features of a word: itself, its beginnings and its end."""
    w = word.lower()
    return ["w" + w, *(f"p{w[:k]}" for k in PREFIXES if len(w) > k), "s" + w[-3:]]


def buckets(spelled: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of distinct words: all in a row, and the number per word."""
    all_, n = [], []
    for w in spelled:
        f = names(w)
        n.append(len(f))
        all_ += [zlib.crc32(x.encode()) % FEATURES for x in f]
    return np.array(all_, np.int64), np.array(n, np.int64)


class Layout:
    """Texts of a batch cut into segments of at most SEGMENT words that advance together."""

    def __init__(self, n: np.ndarray) -> None:
        per = -(-n // SEGMENT)
        self.doc = np.repeat(np.arange(len(n)), per)
        nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        start = np.repeat(np.cumsum(n) - n, per) + nth * SEGMENT
        size = np.minimum(SEGMENT, np.repeat(n, per) - nth * SEGMENT)
        order = np.argsort(-size, kind="stable")  # longest first: those still running are a prefix
        self.order, self.start, self.size = order, start[order], size[order]
        self.live = np.searchsorted(-self.size, -np.arange(1, SEGMENT + 1), side="right") if len(size) else np.zeros(SEGMENT, int)
        self.chains = [np.flatnonzero(nth == k) for k in range(int(per.max()) if len(per) else 0)]
        self.rank = np.empty(len(order), int)
        self.rank[order] = np.arange(len(order))
        self.n_docs = len(n)


def forward_backward(lay: Layout, emit: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of label 1 of each word, and the expected transitions (2 x 2).

    ``emit`` is the score of label 1 of a word (label 0: 0); ``trans`` the scores of
    transitions.  A text starts after label 0.  Probabilities are rescaled at each word:
    first the matrix product of every segment, then the vectors at the borders of the
    segments along each text, then the words inside each segment.
    """
    m = np.exp(trans)
    e1 = np.exp(np.clip(emit, -30, 30))
    s = len(lay.start)
    steps = int(lay.size[0]) if s else 0
    product = np.tile(np.eye(2), (s, 1, 1))
    if len(lay.chains) > 1:
        for k in range(steps):
            live = lay.live[k]
            q = product[:live] @ m
            q[:, :, 1] *= e1[lay.start[:live] + k][:, None]
            product[:live] = q / q.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.empty((s, 2)), np.empty((s, 2))
    state = np.tile([1.0, 0.0], (lay.n_docs, 1))
    for at in lay.chains:
        r, d = lay.rank[at], lay.doc[at]
        enter[r] = state[d]
        x = np.einsum("ij,ijk->ik", state[d], product[r])
        state[d] = x / x.sum(axis=1, keepdims=True)
    state = np.ones((lay.n_docs, 2))
    for at in reversed(lay.chains):
        r, d = lay.rank[at], lay.doc[at]
        leave[r] = state[d]
        x = np.einsum("ijk,ik->ij", product[r], state[d])
        state[d] = x / x.sum(axis=1, keepdims=True)
    alpha = np.empty((len(emit), 2))
    a = enter.copy()
    for k in range(steps):
        live = lay.live[k]
        at = lay.start[:live] + k
        x = a[:live] @ m
        x[:, 1] *= e1[at]
        x /= x.sum(axis=1, keepdims=True)
        alpha[at] = a[:live] = x
    marginal = np.empty(len(emit))
    pairs = np.zeros((2, 2))
    b = leave
    for k in reversed(range(steps)):
        live = lay.live[k]
        at = lay.start[:live] + k
        both = alpha[at] * b[:live]
        marginal[at] = both[:, 1] / both.sum(axis=1)
        back = b[:live].copy()
        back[:, 1] *= e1[at]
        joint = (alpha[at - 1] if k else enter[:live])[:, :, None] * m[None] * back[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = back @ m.T
        b[:live] = back / back.sum(axis=1, keepdims=True)
    return marginal, pairs


class Model:
    """Weights of the field and of the logistic regression that turns marginals into a score."""

    def __init__(self) -> None:
        self.weights = np.zeros(FEATURES, np.float32)
        self.trans = np.zeros((2, 2))
        self.trans[:, 1] = -6.0
        self.score_weights = np.array([-3.0, 0.0, 0.0])

    def emissions(self, spelled: list[str]) -> np.ndarray:
        if not spelled:
            return np.zeros(0)
        f, n = buckets(spelled)
        return np.add.reduceat(self.weights[f].astype(float), np.cumsum(n) - n)

    def marginals(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        codes, n, spelled = tokens(texts)
        p, _ = forward_backward(Layout(n), self.emissions(spelled)[codes] if len(codes) else np.zeros(0), self.trans)
        return p, n, codes, spelled

    def evidence(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Per text: constant, log odds of the largest marginal, log of the expected toxic words."""
        x = np.full((len(n), 3), -12.0)
        x[:, 0] = 1.0
        full = np.flatnonzero(n)
        if len(full):
            at = (np.cumsum(n) - n)[full]
            q = np.clip(p, 1e-6, 1 - 1e-6)
            top = np.maximum.reduceat(q, at)
            x[full, 1] = np.log(top / (1 - top)).clip(-12, 12)
            x[full, 2] = np.log(np.add.reduceat(q, at))
        return x

    def score(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(p, n) @ self.score_weights, -30, 30)))


def token_labels(codes: np.ndarray, n: np.ndarray, spelled: list[str], toxic: np.ndarray) -> np.ndarray:
    """Labels of words from labels of texts.

    A feature is toxic if it is found in far more toxic texts than clean ones: a G-test
    above ``3 ln(number of features in three texts or more)``, and at least 20 times as often.  A word of a
    toxic text is labelled 1 if one of its features is toxic.
    """
    f, k = buckets(spelled)
    word_at = np.cumsum(k) - k
    doc = np.repeat(np.arange(len(n)), n)
    pair = np.unique(doc * np.int64(len(spelled)) + codes)  # distinct words of each text
    d, w = pair // len(spelled), pair % len(spelled)
    reps = k[w]
    at = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(word_at[w], reps)
    hit = np.unique(np.repeat(d, reps) * np.int64(FEATURES) + f[at])
    hd, hf = hit // FEATURES, hit % FEATURES
    bad = np.bincount(hf[toxic[hd]], minlength=FEATURES).astype(float)
    good = np.bincount(hf[~toxic[hd]], minlength=FEATURES).astype(float)
    nb, ng = max(1, toxic.sum()), max(1, (~toxic).sum())
    rate = nb / (nb + ng)
    total = np.maximum(bad + good, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(bad > 0, bad * np.log(bad / (total * rate)), 0)
                 + np.where(good > 0, good * np.log(good / (total * (1 - rate))), 0))
    flagged = (g > 3 * np.log(max(2, np.count_nonzero(bad + good >= 3)))) & (bad / nb > 20 * good / ng)
    is_bad = np.maximum.reduceat(flagged[f], word_at) if len(f) else np.zeros(0, bool)
    return is_bad[codes] & toxic[doc]


def fit(texts: list[str | None], toxic: np.ndarray, class_size: tuple[int, int], steps: int = 40,
        rate: float = 0.5, decay: float = 1e-6) -> Model:
    """Train on a bounded sample of labelled texts.

    Four fifths train the field (full-batch AdaGrad on the conditional likelihood of the
    word labels; toxic texts without a labelled word are left out), one fifth the
    logistic regression, weighted to the ``class_size`` (clean, toxic) of all labelled rows.
    """
    model = Model()
    toxic = np.asarray(toxic, bool)
    if not len(texts) or toxic.all() or not toxic.any():
        share = float(toxic.mean()) if len(toxic) else 0.0
        model.score_weights = np.array([np.log((share + 0.01) / (1.01 - share)), 0.0, 0.0])
        return model
    own = np.arange(len(texts)) % 5 != 0
    part = pa.array([t for t, o in zip(texts, own, strict=True) if o], pa.string())
    codes, n, spelled = tokens(part)
    bad = toxic[own]
    if len(codes):
        y = token_labels(codes, n, spelled, bad)
        doc = np.repeat(np.arange(len(n)), n)
        use = ~bad | (np.bincount(doc[y], minlength=len(n)) > 0)
        codes, y, n = codes[use[doc]], y[use[doc]].astype(float), n[use]
    if len(codes):
        lay = Layout(n)
        f, k = buckets(spelled)
        owner = np.repeat(np.arange(len(spelled)), k)
        first = np.zeros(len(y), bool)
        first[(np.cumsum(n) - n)[n > 0]] = True
        before = np.where(first, 0, np.concatenate([[0], y[:-1]])).astype(int)
        seen = np.zeros((2, 2))
        np.add.at(seen, (before, y.astype(int)), 1)
        weights, gw, gt = np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(2)
        for _ in range(steps):
            emit = np.bincount(owner, weights=weights[f], minlength=len(spelled))
            p, pairs = forward_backward(lay, emit[codes], model.trans)
            by_word = np.bincount(codes, weights=y - p, minlength=len(spelled))
            grad = np.bincount(f, weights=by_word[owner], minlength=FEATURES) - decay * len(y) * weights
            gw += grad * grad
            weights += rate * grad / np.sqrt(gw + 1e-9)
            step = (seen - pairs)[:, 1]
            gt += step * step
            model.trans[:, 1] += rate * step / np.sqrt(gt + 1e-9)
        model.weights = weights.astype(np.float32)
    rest = ~own
    p, n, _, _ = model.marginals(pa.array([t for t, o in zip(texts, rest, strict=True) if o], pa.string()))
    x, z = model.evidence(p, n), toxic[rest].astype(float)
    weight = np.where(z > 0, class_size[1] / max(1, toxic.sum()), class_size[0] / max(1, (~toxic).sum()))
    weight /= weight.mean()
    v = np.zeros(3)
    for _ in range(50):  # Newton steps with a little shrinkage
        q = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(3)
        v += np.linalg.solve(h, x.T @ (weight * (z - q)) - 0.05 * v)
    model.score_weights = v
    return model


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> tuple[list, np.ndarray, tuple[int, int]]:
    """A bounded sample of labelled texts outside the held-out fold, in the order of a hash of the id.

    ``toxic_rows`` and ``clean_rows`` bound it; the ids are chosen from the narrow label
    table, so only the chosen texts leave the scan.
    """
    lab = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    size = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = (lab.where("toxic = 1").orderBy(*order).limit(toxic_rows)
           .unionByName(lab.where("toxic = 0").orderBy(*order).limit(clean_rows)))
    rows = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .orderBy(*order, "text").limit(2 * (toxic_rows + clean_rows)).collect())
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["text"] or ""))
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], bool), (size.get(0, 0), size.get(1, 0))


def score(docs: DataFrame, labels: DataFrame, toxic_rows: int = 1000, clean_rows: int = 3000) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted, spans``.

    ``spans`` are the words with a marginal of 1/2 or more (code point ``start`` and
    ``end``, and the marginal).  Texts are read whole and row by row; the model has a
    fixed size and is the only thing learned, from at most ``toxic_rows`` and
    ``clean_rows`` labelled documents.  A null or empty text has no words and gets the
    score of no evidence; without labels of both kinds all scores are the share of
    toxic ones (0.0099 if there is no label); repeated rows are scored alike; other columns are dropped.
    """
    texts, toxic, class_size = sample(docs, labels, toxic_rows, clean_rows)
    model = fit(texts, toxic, class_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 2000):
                b = big.slice(at, 2000)
                text = b.column(2).cast(pa.string())
                p, n, codes, spelled = model.marginals(text)
                s = model.score(p, n)
                spans: list[list[dict]] = [[] for _ in n]
                ends = np.cumsum(n)
                hot = np.searchsorted(ends, np.flatnonzero(p >= 0.5), side="right")
                for d in np.unique(hot).tolist():
                    raw, pos = text[d].as_py(), 0
                    for j in range(int(ends[d] - n[d]), int(ends[d])):
                        word = spelled[codes[j]]
                        start = raw.index(word, pos)
                        pos = start + len(word)
                        if p[j] >= 0.5:
                            spans[d].append({"start": start, "end": pos, "marginal": float(p[j])})
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                    ["doc_id", "held_out", "score", "predicted", "spans"])

    return docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, "
             "spans array<struct<start: int, end: int, marginal: double>>")
