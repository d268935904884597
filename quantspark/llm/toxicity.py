"""Operator 3: weak supervision. Voters, a generative label model over their votes, and a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import col, slices, small_batches, staged
from quantspark.llm.language_model import held_out

#: Common English insults, the lexicon that needs no labels.
INSULTS = "idiot moron stupid dumb loser trash scum pathetic worthless disgusting clown imbecile jerk bastard filthy vermin".split()
WORD = re.compile(r"\w+")
#: Lengths of word beginnings that may become patterns.
STEMS = (3, 4, 5, 6, 7, 8)
#: Mined words and patterns are dealt to so many voters, the strongest first, so that those of one language differ.
GROUPS = 9
#: So many lexemes are expected to be mined by chance among all that stand in equally many documents.
CHANCE = 0.02


def lexemes(text: str | None) -> set[str]:
    """The distinct words ("=" before them) and word beginnings of a text."""
    words = set(WORD.findall((text or "").lower()))
    found = {w[:k] for k in STEMS for w in words if len(w) >= k}
    found.update("=" + w for w in words)
    return found


def least_toxic(rivals: dict[int, int], positive: int, negative: int) -> dict[int, int]:
    """For each number k of documents, in how many toxic ones at least a lexeme must stand to be mined.

    ``rivals``: how many lexemes stand in k documents. Fewer than CHANCE of them would be in so many by chance, and the
    rate in toxic documents is eight times that in clean ones or more.
    """
    rate, out = positive / (positive + negative), {}
    log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, max(rivals, default=0) + 1)))])
    for k, n in rivals.items():
        p = np.arange(k + 1)
        exactly = np.exp(log_factorial[k] - log_factorial[p] - log_factorial[k - p] + p * log(rate) + (k - p) * log(1 - rate))
        at_least = exactly[::-1].cumsum()[::-1]
        fit = np.flatnonzero((p >= 2) & (p * negative >= 8 * (k - p) * positive) & (at_least * n < CHANCE))
        if len(fit):
            out[k] = int(fit[0])
    return out


def mined(counts: list[tuple[str, int, int]], positive: int, negative: int) -> list[str]:
    """Of words and beginnings that extend each other, the one with the largest log likelihood ratio (the longest, if
    equal), strongest first."""
    rate = positive / (positive + negative)
    gain = {x: (round(p * log(p / (p + n) / rate) + (n * log(n / (p + n) / (1 - rate)) if n else 0), 9), len(x)) for x, p, n in counts}
    shorter = lambda x: [w[:k] for w in (x.lstrip("="),) for k in STEMS if k < len(w) or (x[0] == "=" and k == len(w))]
    beyond: dict[str, tuple[float, int]] = {}
    for x in gain:
        for s in shorter(x):
            beyond[s] = max(beyond.get(s, gain[x]), gain[x])
    kept = [x for x in gain if gain[x] > beyond.get(x, (-1.0, 0)) and not any(gain.get(s, (-1.0, 0)) > gain[x] for s in shorter(x))]
    return sorted(kept, key=lambda x: (-gain[x][0], x))


@dataclass(frozen=True)
class Voters:
    """Lexicon voters, pattern voters and voters on how dense and loud a text is; each votes for toxic (1) or abstains (0)."""

    lexemes: tuple[str, ...]
    at: dict[str, int] = field(init=False, repr=False)
    stems: tuple[int, ...] = field(init=False, repr=False)
    group: tuple[int, ...] = field(init=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "at", {x: i for i, x in enumerate(self.lexemes)})
        object.__setattr__(self, "stems", tuple(sorted({len(x) for x in self.lexemes if x[0] != "="})))
        object.__setattr__(self, "group", tuple(1 + i % GROUPS for i in range(len(self.lexemes))))

    @property
    def names(self) -> list[str]:
        return ["insults", *(f"lexicon-{i}" for i in range(GROUPS)), "several", "dense", "loud"]

    def hits(self, text: str | None) -> tuple[int, int, list[int], list[int]]:
        """Votes as bits, number of words, and which lexemes stand how often."""
        text = text or ""
        words = WORD.findall(text.lower())
        distinct, found = set(words), Counter()
        # most words begin no known pattern: look at distinct words first, and count those few that do
        near = {w for k in self.stems for w in distinct if w[:k] in self.at and len(w) >= k} | {w for w in distinct if "=" + w in self.at}
        insults = 0
        if near or not distinct.isdisjoint(INSULTS):
            for w in words:
                insults += w in INSULTS
                if w in near:
                    found.update(i for i in (self.at.get("=" + w), *(self.at.get(w[:k]) for k in self.stems if len(w) >= k)) if i is not None)
        bits = int(insults > 0)
        for i in found:
            bits |= 1 << self.group[i]
        total = insults + sum(found.values())
        last = GROUPS + 1
        bits |= (len(found) + (insults > 0) > 1) << last | (100 * total >= max(len(words), 1)) << (last + 1) | (text.count("!!") > 2) << (last + 2)
        return bits, len(words), list(found), list(found.values())


@dataclass(frozen=True)
class LabelModel:
    """log odds of toxic = weights @ votes + bias (+ silence, if no voter votes), with what they come from: each voter's
    rate of votes by class, and the correlations left between voters within a class."""

    weights: np.ndarray
    bias: float
    silence: float
    if_toxic: np.ndarray
    if_clean: np.ndarray
    correlations: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(votes @ self.weights + self.bias + self.silence * ~votes.any(1), -30, 30)))


def label_model(votes: np.ndarray, counts: np.ndarray, prior: float, known: np.ndarray | None = None, floor: float = 0.002) -> LabelModel:
    """From vote patterns and how many documents have each, without labels but for the share of toxic ones.

    If two voters are independent within a class, their covariance is d_i d_j p (1 - p), d being the difference of a
    voter's rates between the classes. So each triplet gives d_i, and the median over all triplets is taken; a voter
    that is in no triplet has ``known``, its difference on labelled rows (none: 0). What covariance is left over is correlation within a class (voters that look at the same words). A vote counts by the
    log ratio of its rates, divided by the sum of the voter's correlations, so that correlated voters don't count
    twice; a voter that is silent abstains, and only the silence of all counts against toxic.
    """
    n, m = counts.sum(), votes.shape[1]
    mean = counts @ votes / n
    cov = (votes * counts[:, None]).T @ votes / n - np.outer(mean, mean)
    spread = prior * (1 - prior)
    tied = np.eye(m, dtype=bool)
    for _ in range(2):  # again without triplets that hold a pair which turned out to be correlated
        d = np.zeros(m)
        for i in range(m):
            pairs = [(j, k) for j in range(m) for k in range(j) if not (tied[i, j] or tied[i, k] or tied[j, k])]
            ratios = [cov[i, j] * cov[i, k] / cov[j, k] for j, k in pairs if cov[j, k] > 1e-9 and cov[i, j] > 0 and cov[i, k] > 0]
            d[i] = min(1.0, (np.median(ratios) / spread) ** 0.5) if ratios else 0.0 if known is None else max(0.0, float(known[i]))
        d = np.minimum(d, mean / max(prior, 1e-9))  # no voter can vote oftener on toxic texts than it does at all
        if_clean = np.clip(mean - prior * d, 0, 1)
        if_toxic = np.clip(if_clean + d, 0, 1)
        sd = np.maximum(prior * if_toxic * (1 - if_toxic) + (1 - prior) * if_clean * (1 - if_clean), 1e-4) ** 0.5
        correlations = np.clip((cov - np.outer(d, d) * spread) / np.outer(sd, sd), -0.9, 0.9)
        np.fill_diagonal(correlations, 1.0)
        tied = correlations > 0.7
    low = np.clip(if_clean, floor, 1)
    weights = np.log(np.clip(if_toxic, low, 1) / low) / np.maximum(correlations, 0).sum(1)
    any_clean = 1 - np.prod(1 - if_clean)
    any_toxic = np.clip((counts @ votes.any(1) / n - (1 - prior) * any_clean) / prior, 0.5, 0.98)
    silence = min(0.0, float(np.log((1 - any_toxic) / max(1 - any_clean, 1e-9))))
    return LabelModel(weights, float(np.log(prior / (1 - prior))), silence, if_toxic, if_clean, correlations)


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 0.05, rounds: int = 25) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on soft targets, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * s[:, None]).T @ x + np.diag(penalty), x.T @ (target - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    voters: Voters
    labels: LabelModel
    weights: np.ndarray

    def score_hits(self, n_words: np.ndarray, found: list[list[int]], times: list[list[int]]) -> np.ndarray:
        """The classifier's probability from lexeme counts; it never sees language, source or id."""
        z = np.full(len(found), self.weights[-1])
        for i, (f, t) in enumerate(zip(found, times, strict=True)):
            if len(f):
                z[i] += self.weights[np.asarray(f)] @ np.log2(1 + np.asarray(t, float))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def filter(self, docs: DataFrame, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
        """The rows of ``docs`` that score below ``threshold``, all columns as they were."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chain.from_iterable(map(slices, batches)):
                found = [self.voters.hits(t) for t in batch.column(text_col).to_pylist()]
                p = self.score_hits(np.array([n for _, n, _, _ in found]), [f for *_, f, _ in found], [t for *_, t in found])
                yield batch.filter(pa.array(p < threshold))

        return docs.mapInArrow(run, docs.schema)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int) -> DataFrame:
    """Texts of at most ``fit_rows`` training rows of each label, those with the smallest hashed ids."""
    known = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("toxic")).dropna().groupBy("id").agg(F.max("toxic").alias("toxic"))
    train = known.filter(~held_out(F.col("id"), 3, 1))
    order = [F.xxhash64("id"), F.col("id")]
    chosen = train.filter("toxic > 0").orderBy(*order).limit(fit_rows).unionByName(train.filter("toxic <= 0").orderBy(*order).limit(fit_rows))
    # at most 2 * fit_rows ids
    return staged(docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id"), "labelled-texts")


def _without_copies(sample: DataFrame) -> DataFrame:
    """Of rows that share one of three smallest hashes of three words the first, so that near copies aren't evidence twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            keys = []
            for text in batch.column("text").to_pylist():
                words = WORD.findall((text or "").lower())
                grams = [xxhash.xxh3_64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))]
                keys.append([min(grams) >> 1, max(grams) >> 1, min(g * 0x9E3779B97F4A7C15 % (1 << 64) for g in grams) >> 1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=[*batch.schema.names, "_keys"])

    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in sample.schema)}, _keys array<long>"
    keyed = staged(sample.mapInArrow(run, schema).withColumn("me", F.struct(F.xxhash64("text").alias("h"), "id")).dropDuplicates(["me"]), "sample-keys")
    each = keyed.select("me", F.posexplode("_keys").alias("which", "key"))
    first = each.groupBy("which", "key").agg(F.min("me").alias("first"))
    copies = each.join(first, ["which", "key"]).filter("me <> first").select("me").distinct()
    return staged(keyed.join(copies, "me", "left_anti").select("id", "text", "toxic"), "fit-texts")


def _counted(sample: DataFrame) -> DataFrame:
    """Document counts of each lexeme by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            of = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                of[toxic > 0].update(lexemes(text))
            keys = list(of[1] | of[0])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([of[k][x] for x in keys], pa.int64()) for k in (1, 0))], names=["lexeme", "p", "n"])

    return sample.mapInArrow(run, "lexeme string, p long, n long").groupBy("lexeme").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def with_hits(df: DataFrame, voters: Voters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, votes, n_words, found and times of every whole text."""
    rows = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            bits, n, found, times = zip(*map(voters.hits, batch.column("text").to_pylist()), strict=True) if batch.num_rows else ((), (), (), ())
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(bits, pa.int64()), pa.array(n, pa.int64()), pa.array(found, ints), pa.array(times, ints)], names=["id", "votes", "n_words", "found", "times"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, votes long, n_words long, found array<int>, times array<int>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = 6000) -> tuple[ToxicityModel, DataFrame]:
    """The model, and every document's hits.

    Lexemes are mined, and the classifier is trained, on a bounded sample: at most ``fit_rows`` labelled training rows
    of each label (crc32 of the id mod 3 isn't 1), near copies once. Every lexeme of it that passes ``least_toxic`` is
    taken, however many. The label model's vote patterns are counted over all documents. The share of toxic documents
    comes from all labelled training rows. The classifier's targets are the label model's posteriors; the rows' own
    labels are not among them, and tell the label model no more than the accuracy of voters that are in no triplet.
    """
    small_batches(docs.sparkSession)
    sample = _without_copies(_sample(docs, labels, id_col, text_col, label_col, fit_rows))
    size = sample.groupBy((F.col("toxic") > 0).alias("t")).count().collect()
    positive, negative = (sum(r["count"] for r in size if r["t"] is x) for x in (True, False))
    found: list[str] = []
    if positive:
        counts = staged(_counted(sample), "lexemes").withColumn("k", F.col("p") + F.col("n"))
        rivals = {r[0]: r[1] for r in counts.groupBy("k").count().collect()}  # at most 2 * fit_rows
        least = list(least_toxic(rivals, positive, max(negative, 1)).items())
        rows = counts.join(F.broadcast(sample.sparkSession.createDataFrame(least, "k long, least long")), "k").filter("p >= least").select("lexeme", "p", "n").collect()
        found = mined([tuple(r) for r in rows], positive, max(negative, 1))
    voters = Voters(tuple(found))
    hits = staged(with_hits(docs, voters, id_col, text_col), "hits")

    train = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("toxic")).dropna().filter(~held_out(F.col("id"), 3, 1))
    share = train.agg(F.avg((F.col("toxic") > 0).cast("int"))).first()[0]
    prior = min(0.5, max(0.005, share if share is not None else 0.05))
    patterns = hits.groupBy("votes").count().collect()  # at most 2 ** voters, whatever the input
    m = len(voters.names)
    votes = np.array([[r["votes"] >> i & 1 for i in range(m)] for r in patterns], float).reshape(-1, m)
    fitted = with_hits(sample, voters, "id", "text").join(sample.select("id", "toxic").distinct(), "id").select("votes", "found", "times", "toxic").toPandas()  # at most 2 * fit_rows ids
    x = np.zeros((len(fitted), len(found)))
    for i, (f, t) in enumerate(zip(fitted["found"], fitted["times"], strict=True)):
        x[i, np.asarray(f, int)] = np.log2(1 + np.asarray(t, float))
    own = (fitted["votes"].to_numpy(np.int64)[:, None] >> np.arange(m) & 1).astype(float)
    toxic = fitted["toxic"].to_numpy() > 0
    known = own[toxic].mean(0) - own[~toxic].mean(0) if toxic.any() and not toxic.all() else None
    labelled = label_model(votes, np.array([r["count"] for r in patterns], float), prior, known) if patterns else LabelModel(np.zeros(m), -9.0, 0.0, np.zeros(m), np.zeros(m), np.eye(m))
    weights = logistic(x, labelled.posterior(own)) if len(fitted) else np.append(np.zeros(len(found)), -9.0)
    return ToxicityModel(voters, labelled, weights), hits


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **params) -> DataFrame:
    """id, held_out, score, predicted and the label model's posterior of every document.

    Null and empty texts have no hits and get the score of a clean text. Null ids count as empty ones for the hold-out
    and have no label; repeated ids and rows are scored each; one id with several labels is toxic if one of them is.
    Without labelled toxic rows to learn from no lexemes are mined, so that all documents score alike, below the
    threshold. A score equal to the threshold is toxic. Very long texts: words are counted slice by slice of a batch, one
    text at a time. Empty tables: no rows. Other columns are not read.
    """
    model, hits = fit(docs, labels, id_col, text_col, **params)
    m = len(model.voters.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score_hits(batch.column("n_words").to_numpy(), batch.column("found").to_pylist(), batch.column("times").to_pylist())
            votes = (batch.column("votes").to_numpy()[:, None] >> np.arange(m) & 1).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(p), pa.array(model.labels.posterior(votes))], names=["id", "score", "posterior"])

    out = hits.mapInArrow(run, f"id {hits.schema['id'].dataType.simpleString()}, score double, posterior double")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id"), 3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "posterior")


def op3_weak_supervision(spark, sf_dir: str) -> DataFrame:
    """Query: all documents, learning from labelled rows that aren't held out."""
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
