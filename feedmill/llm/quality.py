"""Quality by positive-unlabelled learning.

Trusted texts are positives; all others are unlabelled, whatever their label.
The class prior comes from the scores of a first classifier, trusted against
unlabelled, over all texts: the share of positives among the unlabelled is the
least ratio of upper tails.  The second classifier, a small network over
measures of the text, minimises the non-negative unbiased risk with that prior.
All unlabelled texts take part in fitting: in a round each partition fits a copy
of the network to its share, and the copies' mean starts the next round.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket, cut, small_batches
from .toxicity import labelled_sample

MARK = re.compile(r"[!|*#$%&@^~<>{}\[\]=+_\\/]")
CAPS = re.compile(r"\b[^\W\d_a-zà-öø-ÿ]{2,}\b")
N_MEASURES = 22


def measures(text: str | None) -> list[float]:
    """Measures of a whole text; of an empty one all but the first are zero."""
    text = text or ""
    words = text.split()
    n, w = len(text), len(words)
    if not w:
        return [1.0, *[0.0] * (N_MEASURES - 1)]
    count = text.count
    counts = Counter(words)
    common = sorted(counts.values(), reverse=True)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(str.isalpha, set(text)))  # of the alphabet used
    kept = len(text.translate(_UPPER_GONE))
    runs = sum(a == b for a, b in zip(words, words[1:]))
    marked = len(MARK.findall(text))
    ends = count(".") + count("!") + count("?")
    return [
        0.0,
        np.log1p(w) / 10,
        len(counts) / w,
        len(counts) / w**0.75,
        common[0] / w,
        sum(common[:5]) / w,
        runs / w,
        (n - kept) / n,
        len(CAPS.findall(text)) / w,
        marked / w,
        count("!") / w,
        count("|") / w,
        (count("*") + count("#") + count("$") + count("%") + count("&")) / w,
        count(".") / w,
        count(",") / w,
        ends / w,
        sum(map(len, words)) / w / 10,
        1 - len({x.strip() for x in lines}) / max(1, len(lines)),
        len(lines) / w,
        sum(map(str.isdigit, text)) / n if any(map(str.isdigit, set(text))) else 0.0,
        np.log1p(letters) / 5,
        sum(len(x) > 12 for x in counts) / len(counts),
    ]


#: Capital letters of Latin-1, taken out.
_UPPER_GONE = {c: None for c in range(0xDF) if chr(c).isupper()}


def measures_column(text: Column) -> Column:
    @F.arrow_udf("array<float>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([measures(x) for x in batch.to_pylist()], pa.list_(pa.float32()))

    return of(text)


@dataclass
class Network:
    """One hidden layer of tanh; inputs are scaled by center and spread."""

    center: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(np.clip((x - self.center) / self.spread, -6, 6) @ a + b) @ c + d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


#: Passes over the unlabelled texts in a round, and rows that are passed over at once.
EPOCHS, HELD = 15, 65_536


def _steps(net: Network, positive: np.ndarray, unlabelled: np.ndarray, risk_grad, rate: float, rng, state: list) -> None:
    """Adam, ``EPOCHS`` times over the unlabelled texts, each batch with as many
    of the trusted; ``risk_grad`` maps both batches' logits to their gradients."""
    first, second = state[0], state[1]
    scaled = lambda x: np.clip((x - net.center) / net.spread, -6, 6)
    positive, unlabelled = scaled(positive), scaled(unlabelled)
    batches = max(1, len(unlabelled) // 256)
    for _ in range(EPOCHS):
        for u in np.array_split(rng.permutation(len(unlabelled)), batches):
            p = rng.choice(len(positive), min(256, len(positive)), replace=False)
            x = np.concatenate((positive[p], unlabelled[u]))
            a, b, c, d = net.layers
            h = np.tanh(x @ a + b)
            z = h @ c + d[0]
            g = np.concatenate(risk_grad(z[: len(p)], z[len(p) :]))
            back = g[:, None] * c * (1 - h * h)
            state[2] += 1
            t = state[2]
            for i, grad in enumerate((x.T @ back + 1e-4 * a, back.sum(0), h.T @ g + 1e-4 * c, np.array([g.sum()]))):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                net.layers[i] = net.layers[i] - rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)


def _copies(net: Network, positive: np.ndarray, risk_grad, rate: float):
    """Rows (i, v): the sum of the weights of a partition's copy, times its
    texts, and as the last the number of texts."""

    def rows(batches):
        mine = Network(net.center, net.spread, [x.copy() for x in net.layers])
        state, rng, n, held = [[np.zeros_like(x) for x in mine.layers], [np.zeros_like(x) for x in mine.layers], 0], np.random.default_rng(3), 0, []
        for batch in batches:
            held.append(_array(batch.column(0)))
            if sum(map(len, held)) >= HELD:
                _steps(mine, positive, np.concatenate(held), risk_grad, rate, rng, state)
                n, held = n + sum(map(len, held)), []
        if sum(map(len, held)):
            _steps(mine, positive, np.concatenate(held), risk_grad, rate, rng, state)
            n += sum(map(len, held))
        flat = np.concatenate([*(x.ravel() for x in mine.layers), [1.0]]) * n
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(flat)), pa.int32()), "v": flat})

    return rows


def _array(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_MEASURES).astype(np.float64)


def _summed(rows: DataFrame) -> np.ndarray:
    """Sums of v by i, a bounded number of rows."""
    got = rows.groupBy("i").agg(F.sum("v").alias("v")).toPandas().sort_values("i")
    return got["v"].to_numpy()


def _moments(batches):
    out = np.zeros(2 * N_MEASURES + 1)
    for batch in batches:
        x = _array(batch.column(0))
        out += np.concatenate((x.sum(0), (x * x).sum(0), [len(x)]))
    yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(out)), pa.int32()), "v": out})


def _fit(positive: np.ndarray, texts: DataFrame, risk_grad, rounds: int, hidden: int = 16, rate: float = 0.01, seed: int = 3) -> Network | None:
    """A network fitted to the trusted and to all of ``texts`` (column x)."""
    rng, x = np.random.default_rng(seed), texts.select("x")
    moments = _summed(x.mapInArrow(_moments, "i int, v double"))
    if not len(moments) or not moments[-1]:
        return None
    mean = moments[:N_MEASURES] / moments[-1]
    spread = np.sqrt(np.maximum(moments[N_MEASURES:-1] / moments[-1] - mean**2, 0)) + 1e-3
    net = Network(mean, spread, [rng.normal(0, N_MEASURES**-0.5, (N_MEASURES, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)])
    for when in range(rounds):
        flat = _summed(x.mapInArrow(_copies(net, positive, risk_grad, rate / 2**when), "i int, v double"))
        cuts = np.cumsum([v.size for v in net.layers])
        net = Network(mean, spread, [v.reshape(was.shape) for v, was in zip(np.split(flat[:-1] / flat[-1], cuts[:-1]), net.layers)])
    return net


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def plain_risk(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trusted against unlabelled, each half of the weight."""
    return (_sigmoid(zp) - 1) / (2 * len(zp)), _sigmoid(zu) / (2 * len(zu))


def non_negative_risk(prior: float):
    """Risk prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with log loss;
    where the second part is negative, its gradient is turned round."""

    def grad(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sp, su = _sigmoid(zp), _sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        turn = 1.0 if negative >= 0 else -1.0
        gp = -turn * prior * sp / len(zp) + (prior * (sp - 1) / len(zp) if negative >= 0 else 0)
        return gp, turn * su / len(zu)

    return grad


def tail_prior(trusted: np.ndarray, every: np.ndarray, least: float = 0.2) -> float:
    """Least ratio of upper tails, from two histograms of scores, over tails
    that hold at least a part ``least`` of the trusted texts.  Small tails vary
    by chance, so a tail's ratio counts as more by its own error."""
    p, u = np.cumsum(trusted[::-1]) / trusted.sum(), np.cumsum(every[::-1]) / every.sum()
    use = p >= least
    ratio, error = u[use] / p[use], 1 / np.sqrt(p[use] * trusted.sum())
    return float(np.clip(ratio[np.argmin(ratio * (1 + 2 * error))], 0.05, 0.99))


def score_measures(column: Column, net: Network) -> Column:
    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(net.score(_array(batch)))

    return of(column)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of its whole text, kept in the shared folder."""
    small_batches(docs.sparkSession)
    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), measures_column(F.col("text")).alias("x")))


def train(texts: DataFrame, labels: DataFrame, learn: Column | None = None, trusted: int = 4000) -> tuple[Network | None, float]:
    """Model and class prior from ``texts`` (doc_id, x; see ``measured``).

    Of the texts labelled 1 at most ``trusted``, the first by a hash of doc_id,
    are fitted, and all texts that may be learned from as unlabelled; the prior is
    measured over these too.  Without trusted texts there is no model.  Rows with
    a null doc_id are unlabelled if ``learn`` says so; equal hashes go by doc_id;
    repeated rows count each; only doc_id and x are read.
    """
    learn = F.lit(True) if learn is None else learn
    texts = texts.where(learn)
    sample, totals = labelled_sample(labels, "quality", learn, trusted)
    if not totals.get(1):
        return None, float("nan")
    good = sample.where("label = 1").select("doc_id")
    p = np.array(texts.join(F.broadcast(good), "doc_id").orderBy("doc_id").toPandas()["x"].tolist(), np.float64).reshape(-1, N_MEASURES)
    first = _fit(p, texts, plain_risk, 2) if len(p) else None
    if first is None:
        return None, float("nan")
    positives = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).alias("good")).distinct()
    bins = texts.join(positives, "doc_id", "left").select(F.least(F.floor(score_measures(F.col("x"), first) * 200), F.lit(199)).alias("bin"), "good").groupBy("bin").agg(F.count("*").alias("every"), F.count("good").alias("trusted")).toPandas()
    every, held = np.zeros(200), np.zeros(200)
    every[bins["bin"]], held[bins["bin"]] = bins["every"], bins["trusted"]
    prior = tail_prior(held, every) if held.sum() else 0.5
    return _fit(p, texts, non_negative_risk(prior), 4), prior


def score(texts: DataFrame, net: Network | None) -> DataFrame:
    """``texts`` (doc_id, x) with ``score``, the chance of good quality.  Empty
    and null texts have measures, so also a score; very long texts are measured
    whole.  Repeated rows are scored each; an empty table gives an empty result; a
    column named ``score`` is replaced.  Without a model all scores are 0.5."""
    return texts.withColumn("score", F.lit(0.5) if net is None else score_measures(F.col("x"), net))


def held_out(remainder: int = 0, n: int = 5) -> Column:
    return bucket(F.col("doc_id"), n) == remainder
