"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read a clause's words side by side: insults (words and word beginnings with weights
learned from labels), threats, targets, negation and reported speech. Their composition emits each
insult or threat together with the scope it stands in - plain, negated or reported, aimed at somebody or
not - and a clause's score sums what was emitted. A document's sums go through a logistic curve whose
weights are fitted as well, so how much a negation takes away is measured, not assumed.

Learning uses labelled rows only, at most `TOXIC_ROWS` and `CLEAN_ROWS` of them, drawn by a hash of doc_id;
rows with crc32(doc_id) mod 4 = 2 are never used. The lexicon comes from all of these rows; the
scope weights from each of `PARTS` parts in turn, seen through the lexicon of the other parts, so a part may lack a class. A lexicon entry occurs in `LEAST_SHARE` of the toxic rows at least, so
there are at most (words in a toxic text) / LEAST_SHARE entries however large the tables are. Scoring reads
whole texts where they lie, without a shuffle. Without toxic or clean labels every score is 0.

NULL text: as an empty one; it gets the score of a text without a match. NULL doc_id: never held out,
never labelled. Equal rows are all scored. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from charlake.llm.common import slices
from charlake.llm.registry import query, table
from charlake.operators.scratch import written

# Bounds of the labelled sample.
TOXIC_ROWS = 20_000
CLEAN_ROWS = 40_000
PARTS = 4
# A lexicon entry: how common among toxic rows, in how many at least, and how much more likely there.
LEAST_SHARE, LEAST_ROWS, LEAST_WEIGHT, MOST_WEIGHT = 0.002, 4, 3.0, 8.0
BEGINNINGS = (4, 5, 6)
# Words a task remembers.
REMEMBERED = 500_000
THRESHOLD = 0.3
NEGATION_REACH = 3

# The closed word classes of the grammar.
THREATS = frozenset("kill hurt destroy murder shoot stab strangle töten umbringen schlagen vernichten tuer frapper détruire matar golpear destruir".split())
TARGETS = frozenset(
    "you your yours he she him her they them u du dich dir ihr euch sie er tu toi vous te il elle ils tú usted ustedes vosotros él ella ellos".split()
)
NEGATIONS = frozenset("not never isn't aren't wasn't don't doesn't nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco".split())
REPORTS = frozenset("said says told wrote quoted claimed called sagte schrieb nannte dit écrit appelé dijo escribió llamó".split())

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_QUOTES = re.compile(r'["“”„«»]')


@dataclass(frozen=True)
class Transducer:
    """A deterministic finite-state transducer over word classes: next state and output of each (state, class)."""

    start: int
    arcs: dict[tuple[int, str], tuple[int, str]]

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), self.arcs.get((state, "*"), (state, "")))


def compose(*parts: Transducer) -> Transducer:
    """One transducer that runs the parts side by side and joins what they emit."""
    symbols = sorted({s for p in parts for _, s in p.arcs} | {"*"})
    states, arcs, todo = {tuple(p.start for p in parts): 0}, {}, [tuple(p.start for p in parts)]
    while todo:
        now = todo.pop()
        for symbol in symbols:
            steps = [p.step(s, symbol) for p, s in zip(parts, now, strict=True)]
            then = tuple(s for s, _ in steps)
            if then not in states:
                states[then] = len(states)
                todo.append(then)
            arcs[states[now], symbol] = (states[then], "".join(o for _, o in steps))
    return Transducer(0, arcs)


# I insult, H threat, T target, N negation, R report word or quotation mark.
INSULT = Transducer(0, {(0, "I"): (0, "i")})
THREAT = Transducer(0, {(0, "H"): (0, "h")})
TARGET = Transducer(0, {(0, "T"): (1, ""), (1, "*"): (1, ""), (1, "I"): (1, "t"), (1, "H"): (1, "t")})
NEGATION = Transducer(
    0,
    {(0, "N"): (NEGATION_REACH, "")}
    | {(k, "N"): (NEGATION_REACH, "") for k in range(1, NEGATION_REACH + 1)}
    | {(k, "*"): (k - 1, "") for k in range(1, NEGATION_REACH + 1)}
    | {(k, s): (k - 1, "n") for k in range(1, NEGATION_REACH + 1) for s in "IH"},
)
REPORT = Transducer(0, {(0, "R"): (1, ""), (1, "*"): (1, ""), (1, "I"): (1, "r"), (1, "H"): (1, "r")})
GRAMMAR = compose(INSULT, THREAT, TARGET, NEGATION, REPORT)

FEATURES = ("plain", "negated", "reported", "aimed", "threat", "clauses", "share", "best")


def beginnings(word: str) -> list[str]:
    """The lexicon keys of a word: itself, and its beginnings marked with a dash."""
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n)]


def matched_clauses(text: str, weight: dict[str, float]) -> list[dict[str, float]]:
    """Of each clause with an insult or threat, the weights by scope. `weight` has the insults among its words."""
    out = []
    for clause in _CLAUSE.split(text.lower()):
        state, sums, hit = GRAMMAR.start, dict.fromkeys(FEATURES[:5], 0.0), False
        quoted = _QUOTES.search(clause) is not None
        if quoted:
            state, _ = GRAMMAR.step(state, "R")
        for word in _WORD.findall(clause):
            w = weight.get(word, 0.0)
            symbol = "I" if w else "H" if word in THREATS else "T" if word in TARGETS else "N" if word in NEGATIONS else "R" if word in REPORTS else "*"
            state, emitted = GRAMMAR.step(state, symbol)
            if "h" in emitted:
                hit, sums["threat"] = True, sums["threat"] + (0.0 if "n" in emitted or "r" in emitted else 1.0)
            if "i" in emitted:
                hit = True
                scope = "negated" if "n" in emitted else "reported" if "r" in emitted else "plain"
                sums[scope] += w
                sums["aimed"] += w * ("t" in emitted and scope == "plain")
        if hit:
            out.append(sums)
    return out


class Lookup:
    """Words looked up in a lexicon once; a task keeps it from one slice of texts to the next."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.seen: set[str] = set()
        self.weight: dict[str, float] = {}
        self.marked = set(THREATS)

    def learn(self, words: list[str]) -> None:
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        for word in set(words).difference(self.seen):
            self.seen.add(word)
            w = max(self.lexicon.get(k, 0.0) for k in beginnings(word))
            if w:
                self.weight[word] = w
                self.marked.add(word)


def features(texts: list[str], lookup: Lookup) -> np.ndarray:
    """A row of FEATURES for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        words = _WORD.findall(text.lower())
        lookup.learn(words)
        hits = [w for w in words if w in lookup.marked]
        if hits:
            clauses = matched_clauses(text, lookup.weight)
            sums = {f: sum(c[f] for c in clauses) for f in FEATURES[:5]}
            out[i, :5] = [np.log1p(sums[f]) for f in FEATURES[:5]]
            out[i, 5] = np.log1p(len(clauses))
            out[i, 6] = np.sqrt(len(hits) / len(words))
            out[i, 7] = max((c["plain"] for c in clauses), default=0.0) / MOST_WEIGHT
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights (the last is the constant) by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: tuple[float, ...]

    def score(self, texts: list[str], lookup: Lookup) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(texts))
        z = features(texts, lookup) @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """text, toxic, part (0 to 3) of the labelled sample, equal texts once, toxic if one of them is. The sample's ids are bounded, so they are broadcast."""
    usable = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    luck = F.xxhash64(F.col("doc_id").cast("long"))
    toxic = usable.where("toxic = 1").orderBy(luck, "doc_id").limit(TOXIC_ROWS)
    clean = usable.where("toxic = 0").orderBy(luck, "doc_id").limit(CLEAN_ROWS)
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(toxic.union(clean)), "doc_id")
    return rows.select("text", "toxic", F.pmod(F.xxhash64("text"), F.lit(PARTS)).alias("part")).groupBy("text", "part").agg(F.max("toxic").alias("toxic"))


def learn_lexicons(rows: DataFrame) -> list[dict[str, float]]:
    """Words and beginnings with the log odds of standing in toxic texts: of all rows but a part's for each part, then of all rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, cells = frame["text"].tolist(), (2 * frame["part"] + frame["toxic"]).tolist()
            for a, b in slices([len(t) for t in texts]):
                counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(2 * PARTS, np.int64))
                for text, cell in zip(texts[a:b], cells[a:b], strict=True):
                    for key in {"", *(k for w in set(_WORD.findall(text.lower())) for k in beginnings(w))}:  # "": the number of texts
                        counts[key][cell] += 1
                table_ = pd.DataFrame(list(counts.values()), columns=cells_)
                table_.insert(0, "key", list(counts))
                yield table_

    cells_ = [f"n{i}" for i in range(2 * PARTS)]
    sums = rows.mapInPandas(run, "key string, " + ", ".join(f"{n} long" for n in cells_)).groupBy("key").agg(*[F.sum(n).alias(n) for n in cells_])
    sums = written(sums, "toxic-words")
    totals = sums.where("key = ''").first()
    weights = []
    for out in range(PARTS + 1):
        used = [p for p in range(PARTS) if p != out]
        t, c = (sum((F.col(f"n{2 * p + y}") for p in used), F.lit(0)) for y in (1, 0))
        t_all, c_all = (sum(totals[f"n{2 * p + y}"] for p in used) if totals else 0 for y in (1, 0))
        weight = F.log((t + 0.5) / (t_all + 1)) - F.log((c + 0.5) / (c_all + 1))
        enough = t >= max(LEAST_ROWS, LEAST_SHARE * t_all)
        weights.append(F.when(enough & (weight >= LEAST_WEIGHT), F.least(weight, F.lit(float(MOST_WEIGHT)))) if t_all and c_all else F.lit(None).cast("double"))
    found = sums.where("key <> ''").select("key", *[w.alias(f"w{i}") for i, w in enumerate(weights)])
    found = found.where(F.coalesce(*[F.col(f"w{i}") for i in range(PARTS + 1)]).isNotNull()).collect()
    return [{r["key"]: r[f"w{i}"] for r in found if r[f"w{i}"] is not None} for i in range(PARTS + 1)]


def learn(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """The lexicon of all rows, and scope weights from each part's texts under the lexicon of the others, so that none is weighed by words it taught."""
    rows = written(training_rows(docs, labels, text), "toxic-rows")
    *without, lexicon = learn_lexicons(rows)
    names = [f"f{i}" for i in range(len(FEATURES))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookups = [Lookup(words) for words in without]
        for whole in frames:
            for part, frame in whole.groupby("part"):
                texts = frame["text"].tolist()
                for a, b in slices([len(t) for t in texts]):
                    yield pd.DataFrame(features(texts[a:b], lookups[int(part)]), columns=names).assign(toxic=frame["toxic"].iloc[a:b].to_numpy())

    # A few numbers for each row of the bounded sample.
    table_ = rows.mapInPandas(run, ", ".join(f"{n} double" for n in names) + ", toxic int").toPandas()
    if table_["toxic"].nunique() < 2:
        return Model(lexicon, ())
    return Model(lexicon, tuple(fit(table_[names].to_numpy(), table_["toxic"].to_numpy(float))))


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.lexicon)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in slices([len(t) for t in texts]):
                scores = model.score(texts[a:b], lookup)
                columns = [*batch.slice(a, b - a).columns[:2], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))
