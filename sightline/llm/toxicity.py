"""Toxicity by weak supervision: many voters, a label model over them, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.text import map_texts, with_long_id
from sightline.session import discard, materialize

#: fixed values: insults that vote from the start, whatever the labelled rows hold
INSULTS = (
    "idiot moron stupid loser pathetic scum worthless trash clown disgusting dumb imbecile jerk bastard filth "
    "vermin retard freak coward garbage"
)
LETTERS = re.compile(r"[^\W\d_]+")
LOUD = re.compile(r"\b[A-Z]{4,}\b")
PATTERNS = ["two_entries", "dense", "no_entry", "shouting", "exclaiming"]
SHAPE = ["log_entries", "log_hits", "hits_per_100", "upper_share", "exclamations"]


@dataclass(frozen=True)
class Toxicity:
    """``labelled`` bounds the rows that are learnt from, by a hash of their id.

    A word or word start of ``prefixes`` letters becomes a voter when its log odds between the two
    labels are ``least_z`` standard errors above zero and its lift is at least ``least_lift``. Of
    these, voters are taken greedily until every toxic row has ``cover`` of them where it can, so
    that a large group of copies does not fill the list with its own words. Given labels vote too;
    ``trust`` is the share of them taken to be right.
    """

    labelled: int = 20_000
    candidates: int = 60_000
    voters: int = 160
    cover: int = 3
    prefixes: tuple[int, ...] = (3, 4, 5, 6)
    least_documents: int = 3
    least_z: float = 2.8
    least_lift: float = 8.0
    rounds: int = 60
    trust: float = 0.95


@dataclass
class Model:
    entries: dict[str, int]  # "word" or "start*" -> voter
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def keys_of(word: str, prefixes: tuple[int, ...]) -> list[str]:
    return [word, *(word[:n] + "*" for n in prefixes if len(word) > n)]


def describe(text: str | None, entries: dict[str, int], p: Toxicity) -> np.ndarray:
    """Votes of the entries (0 or 1), then patterns and the shape of a text; zeros for an empty one."""
    out = np.zeros(max(entries.values(), default=-1) + 1 + len(PATTERNS) + len(SHAPE))
    text = text or ""
    counts = Counter(LETTERS.findall(text.lower()))
    different, hits = 0, 0
    for word, n in counts.items():
        own = [entries[k] for k in keys_of(word, p.prefixes) if k in entries]
        if own:
            out[own] = 1
            different, hits = different + 1, hits + n
    total = max(sum(counts.values()), 1)
    upper, exclaimed = len(LOUD.findall(text)), text.count("!")
    dense = 100 * hits / total
    votes = [different > 1, dense > 1, not hits, upper > 0.2 * total, exclaimed > 0.05 * total]
    shape = [np.log1p(different), np.log1p(hits), min(dense, 20), upper / total, min(exclaimed / total, 1)]
    out[-len(PATTERNS) - len(SHAPE) :] = [*map(float, votes), *shape]
    return out


def mined(sample: DataFrame, p: Toxicity) -> dict[str, int]:
    """Entries whose presence tells the labels of the bounded sample apart, and the fixed insults.

    Keys are counted over toxic rows first; only the ``candidates`` most frequent are then counted
    over the others.
    """
    schema = "entry string, n long"

    def counted(wanted: set[str] | None):
        def make(texts, kept):
            counts: Counter = Counter()
            for text in texts:
                words = set(LETTERS.findall((text or "").lower()))
                own = {k for w in words for k in keys_of(w, p.prefixes)}
                counts.update(own if wanted is None else own & wanted)
            return list(counts), list(counts.values())

        return make

    toxic, clean = sample.filter("toxic = 1"), sample.filter("toxic = 0")
    sizes = dict(sample.groupBy("toxic").count().collect())
    a_all, b_all = sizes.get(1, 0), sizes.get(0, 0)
    total = lambda df, make: map_texts(df, "text", [], make, schema).groupBy("entry").agg(F.sum("n").alias("n"))
    often = total(toxic, counted(None)).filter(F.col("n") >= p.least_documents)
    in_toxic = {r["entry"]: r["n"] for r in often.orderBy(F.desc("n"), "entry").limit(p.candidates).collect()}
    in_clean = dict(total(clean, counted(set(in_toxic))).collect())
    scored = {}
    for entry, a in in_toxic.items():
        b = in_clean.get(entry, 0)
        odds = np.log((a + 0.5) / (a_all - a + 0.5)) - np.log((b + 0.5) / (b_all - b + 0.5))
        error = np.sqrt(1 / (a + 0.5) + 1 / (a_all - a + 0.5) + 1 / (b + 0.5) + 1 / (b_all - b + 0.5))
        lift = ((a + 0.5) / (a_all + 1)) / ((b + 0.5) / (b_all + 1))
        if odds / error >= p.least_z and lift >= p.least_lift:
            scored[entry] = len(scored)

    def entries_of(texts, kept):
        words = [set(LETTERS.findall((t or "").lower())) for t in texts]
        return ([sorted({scored[k] for w in own for k in keys_of(w, p.prefixes) if k in scored}) for own in words],)

    rows = map_texts(toxic, "text", [], entries_of, "own array<int>").collect()
    chosen = covering([r["own"] for r in rows], len(scored), p)
    names = list(scored)
    return {entry: i for i, entry in enumerate(dict.fromkeys([*(names[i] for i in chosen), *INSULTS.split()]))}


def covering(rows: list[list[int]], n: int, p: Toxicity) -> list[int]:
    """Entries in the order of how many rows they still help; ties to the earlier entry."""
    where: list[list[int]] = [[] for _ in range(n)]
    for i, own in enumerate(rows):
        for entry in own:
            where[entry].append(i)
    if not n:
        return []
    entry_of = np.repeat(np.arange(n), [len(x) for x in where])
    row_of = np.array([i for x in where for i in x])
    need = np.full(len(rows), p.cover)
    chosen: list[int] = []
    while len(chosen) < p.voters:
        gain = np.bincount(entry_of, weights=need[row_of] > 0, minlength=n)
        gain[chosen] = 0
        best = int(gain.argmax())
        if gain[best] < p.least_documents:
            break
        chosen.append(best)
        need[where[best]] -= 1
    return chosen


def label_model(votes: np.ndarray, given: np.ndarray, p: Toxicity) -> np.ndarray:
    """Posterior of label 1 per row, from votes (0 or 1) and the given labels as one more voter.

    Expectation-maximisation of each voter's rates under both labels. Voters that still agree
    within a label are correlated; a voter's evidence is divided by one plus its correlations, so
    a word and its own start do not count twice. It starts from the given labels, whose rates are
    known (``trust``): estimated ones would let the many voters that are silent on a short toxic text
    outvote its label.
    """
    seen = np.column_stack([votes, given])
    posterior = 0.05 + 0.9 * given
    weight = np.ones(seen.shape[1])
    for step in range(p.rounds):
        share = np.clip(posterior.mean(), 0.001, 0.999)
        rates = [((w[:, None] * seen).sum(0) + 0.1) / (w.sum() + 0.2) for w in (1 - posterior, posterior)]
        rates[0][-1], rates[1][-1] = 1 - p.trust, p.trust
        if step % 5 == 0:
            centred = seen - np.outer(1 - posterior, rates[0]) - np.outer(posterior, rates[1])
            deviation = np.sqrt((centred**2).mean(0)) + 1e-3
            correlation = np.abs((centred.T @ centred) / len(seen) / np.outer(deviation, deviation))
            np.fill_diagonal(correlation, 0)
            weight = 1 / (1 + np.where(correlation > 0.1, correlation, 0).sum(1))
            weight[-1] = 1
        evidence = seen * np.log(rates[1] / rates[0]) + (1 - seen) * np.log((1 - rates[1]) / (1 - rates[0]))
        odds = np.log(share / (1 - share)) + evidence @ weight
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - posterior).max() < 1e-6:
            break
        posterior = new
    return posterior


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias for soft labels, by Newton's method with a small penalty."""
    design = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge * len(x)] * x.shape[1] + [1e-6])
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        mu = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (mu - y) + penalty @ w
        hessian = (design * (mu * (1 - mu))[:, None]).T @ design + penalty + 1e-9 * np.eye(len(w))
        change = np.linalg.solve(hessian, gradient)
        w -= change
        if np.abs(change).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def learnt(docs: DataFrame, labels: DataFrame, p: Toxicity) -> Model:
    """Fit on at most ``labelled`` rows whose label may be seen. Without any, insults alone decide."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter("toxic in (0, 1)")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.labelled)
    # at most p.labelled narrow rows; of rows that repeat an id the one with the smallest text is learnt from
    found = with_long_id(docs).join(F.broadcast(chosen), "doc_id")
    sample = materialize(found.groupBy("doc_id", "toxic").agg(F.min(F.col("text").cast("string")).alias("text")), "sample")
    entries = mined(sample, p)

    def make(texts, kept):
        return kept["doc_id"], kept["toxic"], [describe(t, entries, p) for t in texts]

    rows = map_texts(sample, "text", ["doc_id", "toxic"], make, "doc_id long, toxic int, x array<double>")
    rows = sorted(rows.collect())
    discard(sample)
    if not rows:
        x = np.stack([describe("", entries, p), describe(INSULTS, entries, p)])
        given = np.array([0.0, 1.0])
    else:
        x, given = np.array([r["x"] for r in rows]), np.array([float(r["toxic"]) for r in rows])
    votes = x[:, : len(entries) + len(PATTERNS)]
    target = label_model(votes, given, p)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-3] = 1.0
    weights, bias = logistic((x - mean) / scale, target)
    return Model(entries, weights, bias, mean, scale)


def toxicity_table(docs: DataFrame, labels: DataFrame, p: Toxicity | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its text alone.

    Null and empty texts get the score of a text without words. Rows without a doc_id count as not
    held out; repeated rows are scored each; rows that repeat an id among the labels count once, as
    toxic if one says so. An empty table gives no rows, and without labels the fixed insults decide.
    """
    p = p or Toxicity()
    model = learnt(docs, labels, p)

    def make(texts, kept):
        x = np.array([describe(t, model.entries, p) for t in texts]).reshape(len(texts), len(model.mean))
        odds = ((x - model.mean) / model.scale) @ model.weights + model.bias
        return kept["doc_id"], 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    scored = map_texts(with_long_id(docs), "text", ["doc_id"], make, "doc_id long, score double")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
