"""Toxicity by weak supervision: many voters, a generative model of them, a linear classifier.

1. Lexicon. Words and word beginnings that are far likelier in toxic texts than in others
   are mined from all labelled rows that may be learned from, in one aggregation. A term must
   stand in many different contexts (next words), so that copies of one text don't teach its
   vocabulary. Every term that passes stays; only those come to the driver and to the tasks
   (their number is logged).
2. Voters. A lexicon voter has the terms of one kind (words or beginnings) and one tier of
   precision, and votes if a text has any of them (or, for a second one, has one twice);
   patterns (shouting, repeated marks, masked letters, address) vote besides. A text's votes
   are a bit mask; counts of masks over all rows are the label model's only input, at most
   3 x 2**16 rows however large the table.
3. Label model. Two classes; within each, a vote depends on the class and on one other vote
   (the tree of strongest dependencies), so accuracies and correlations are both estimated.
   Expectation-maximisation: known labels are held, others get posteriors.
4. Classifier. Logistic regression on terms and votes, with the label model's posteriors as
   targets of all rows, also of those whose label is known, on at most ``SAMPLE`` rows chosen by
   a hash among those that may be learned from. Terms in fewer than ``LEAST_ROWS`` of them have
   no weight of their own and count through their voters, which bounds the columns by the sample.

Null and empty texts have no terms and no votes and get the score that goes with that. Rows
with a null id are scored and never learned from. A label table may repeat ids: an id is
toxic if any of its rows says so. Without any toxic label every score is 0. Columns other
than id and text are ignored.
"""

from __future__ import annotations

import json
import logging
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from railpulse.llm.tables import least_hashes, stored, whole_text
from railpulse.operators.timetable import join_on

log = logging.getLogger(__name__)
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
SAMPLE, HELD = 20_000, 200_000
#: A term must be in so many toxic texts, and in so many sampled rows for a weight of its own.
LEAST, LEAST_ROWS = 3, 3
TIERS = (0.9, 0.7)  # lower bounds of precision; the last tier has the rest
LEAST_ODDS, LEAST_GAIN = 1.5, 9.0
#: What the pattern voters look for.
PATTERNS = tuple(re.compile(p) for p in (
    r"[A-Z]{3,}\W+[A-Z]{3,}",
    r"[!?]{2,}",
    r"[A-Za-z][*#@$][*#@$A-Za-z]",
    r"(?i)\b(?:you|your|du|dein|tu|vous|votre|tú|usted)\b",
))
LEXICON_VOTERS = 4 * (len(TIERS) + 1)
VOTERS = LEXICON_VOTERS + len(PATTERNS)


def terms_of(words: set[str]) -> set[str]:
    """Words, and beginnings of longer words marked by a trailing hyphen."""
    found = set(words)
    for length in STEMS:
        found.update([word[:length] + "-" for word in words if len(word) > length])
    return found


# --- lexicon -------------------------------------------------------------------------

def _counted(rows: DataFrame) -> DataFrame:
    """``term, n, other, contexts``: toxic and clean texts with the term, different contexts in toxic ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def flush() -> pa.RecordBatch:
            n, other, masks = (np.array(column, np.uint64).view(np.int64) for column in zip(*held.values()))
            out = pa.RecordBatch.from_pydict({"term": pa.array(list(held), pa.string()), "n": n,
                                              "other": other, "contexts": masks})
            held.clear()
            return out

        for batch in batches:
            for value, toxic in zip(batch["text"], batch["toxic"].to_pylist()):
                words = WORD.findall(value.as_py().lower())
                if toxic == 1:
                    masks: Counter = Counter()
                    for word, after in dict(zip(words, [*words[1:], ""])).items():
                        bit = 1 << (sum(after.encode()) * 40503 >> 3) % 64
                        for term in terms_of({word}):
                            masks[term] |= bit
                    for term, mask in masks.items():
                        entry = held.setdefault(term, [0, 0, 0])
                        entry[0] += 1
                        entry[2] |= mask
                else:
                    for term in terms_of(set(words)):
                        held.setdefault(term, [0, 0, 0])[1] += 1
                if len(held) > HELD:
                    yield flush()
        if held:
            yield flush()

    counts = rows.select(whole_text().alias("text"), "toxic").mapInArrow(
        count, "term string, n long, other long, contexts long")
    return counts.groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("other").alias("other"), F.expr("bit_count(bit_or(contexts))").alias("contexts"))


def lexicon_of(labelled: DataFrame) -> DataFrame:
    """``term, precision, gain`` of every term that passes, from rows of ``text, toxic``.

    The bounds are the same at every size, and every term that passes them stays.
    """
    sizes = {row["toxic"]: row["count"] for row in labelled.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    rate = max(toxic, 1) / max(toxic + clean, 1)
    n, other = F.col("n"), F.col("other")
    both = n + other
    odds = F.log((n + 0.5) / (toxic + 1.0)) - F.log((other + 0.5) / (clean + 1.0))
    # How much likelier the term's labels are at its own rate than at that of all texts.
    gain = n * F.log(n / (both * rate)) + F.when(
        other > 0, other * F.log(other / (both * (1 - rate)))).otherwise(0.0)
    varied = F.col("contexts") >= F.least(F.lit(8), F.greatest(F.lit(2), F.floor(n * 0.3)))
    return (_counted(labelled).where((n >= LEAST) & varied & (odds >= LEAST_ODDS))
            .select("term", ((n + 0.5) / (both + 1)).alias("precision"), gain.alias("gain"))
            .where(F.col("gain") >= LEAST_GAIN))


def mine_lexicon(labelled: DataFrame) -> list[tuple[str, float]]:
    """Terms with their precision in falling order of evidence."""
    rows = sorted(lexicon_of(labelled).collect(), key=lambda row: (-row["gain"], row["term"]))
    return [(row["term"], row["precision"]) for row in rows]


def votes_of(term: str, precision: float) -> tuple[int, int]:
    """Masks of the voters for a text with the term once, and twice."""
    tier = sum(precision < bound for bound in TIERS)
    voter = 4 * tier + 2 * term.endswith("-")
    return 1 << voter, 3 << voter


def term_hits(docs: DataFrame, lexicon: list[tuple[str, float]]) -> DataFrame:
    """``doc_id``, terms by number, and votes; one pass over all texts.

    Term ``k`` is listed as ``k``, and as ``k + len(lexicon)`` too if it stands there twice or more.
    """
    number = {term: k for k, (term, _) in enumerate(lexicon)}
    masks = [votes_of(*entry) for entry in lexicon]

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, votes = [], []
            for value in batch["text"]:
                text = value.as_py()
                times: dict[int, int] = defaultdict(int)
                for word, n in Counter(WORD.findall(text.lower())).items():
                    for term in (word, word[:4] + "-", word[:5] + "-", word[:6] + "-"):
                        if (k := number.get(term)) is not None and len(term) <= len(word):
                            times[k] += n
                found.append(sorted([*times, *(k + len(lexicon) for k, n in times.items() if n > 1)]))
                mask = 0
                for k, n in times.items():
                    mask |= masks[k][n > 1]
                for k, pattern in enumerate(PATTERNS):
                    if pattern.search(text):
                        mask |= 1 << (LEXICON_VOTERS + k)
                votes.append(mask)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.list_(pa.int32())), pa.array(votes, pa.int32())],
                ["doc_id", "hits", "votes"])

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        hits, "doc_id long, hits array<int>, votes int")


# --- label model ---------------------------------------------------------------------

def bits_of(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(VOTERS)) & 1


@dataclass
class LabelModel:
    """Class prior, the tree of dependencies, and P(vote | parent's vote, class)."""

    prior: float
    parents: list[int]
    tables: np.ndarray  # voter, class, parent's vote -> P(vote = 1)
    accuracies: np.ndarray  # voter, class -> P(vote = 1)
    dependence: np.ndarray  # mutual information of two votes, given the class

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        votes = bits_of(masks)
        logs = np.tile(np.log([1 - self.prior, self.prior]), (len(masks), 1))
        for j, parent in enumerate(self.parents):
            above = votes[:, parent] if parent >= 0 else np.zeros(len(masks), int)
            p = self.tables[j][:, above].T
            logs += np.log(np.where(votes[:, j:j + 1] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -60, 60)))


def _maximised(votes: np.ndarray, weights: np.ndarray) -> LabelModel:
    """``weights``: a column per class."""
    n = votes.shape[1]
    total = weights.sum(0)
    single = (votes.T @ weights + 0.5) / (total + 1)
    joint = np.stack([(votes * weights[:, c:c + 1]).T @ votes for c in (0, 1)])
    dependence = np.zeros((n, n))
    for c in (0, 1):
        for a in (0, 1):
            for b in (0, 1):
                pair = joint[c]
                ones = votes.T @ weights[:, c]
                count = {(1, 1): pair, (1, 0): ones[:, None] - pair, (0, 1): ones[None, :] - pair,
                         (0, 0): total[c] - ones[:, None] - ones[None, :] + pair}[a, b]
                p = (np.maximum(count, 0) + 0.25) / (total[c] + 1)
                pa_ = single[:, c] if a else 1 - single[:, c]
                pb_ = single[:, c] if b else 1 - single[:, c]
                dependence += total[c] / total.sum() * p * np.log(p / np.outer(pa_, pb_))
    np.fill_diagonal(dependence, 0)
    parents, inside = [-1] * n, [0]
    while len(inside) < n:  # the spanning tree of largest dependence
        rest = [j for j in range(n) if j not in inside]
        block = dependence[np.ix_(inside, rest)]
        i, j = np.unravel_index(block.argmax(), block.shape)
        parents[rest[j]] = inside[i]
        inside.append(rest[j])
    tables = np.zeros((n, 2, 2))
    for j, parent in enumerate(parents):
        for c in (0, 1):
            for above in (0, 1):
                chosen = weights[:, c] * (votes[:, parent] == above if parent >= 0 else 1)
                # Two pseudo-counts at the rate of the class alone.
                tables[j, c, above] = ((chosen * votes[:, j]).sum() + 2 * single[j, c]) / (chosen.sum() + 2)
    return LabelModel(float((total[1] + 0.5) / (total.sum() + 1)), parents, np.clip(tables, 1e-6, 1 - 1e-6),
                      single, dependence)


def fit_label_model(masks: np.ndarray, labels: np.ndarray, counts: np.ndarray, rounds: int = 30) -> LabelModel:
    """``labels``: 0, 1, or -1 where unknown; a row per mask and label with its count."""
    votes, known = bits_of(masks).astype(float), labels >= 0
    share = np.where(known, labels, 0).astype(float)
    model = _maximised(votes, np.stack([1 - share, share], 1) * (counts * known)[:, None])
    for _ in range(rounds):
        share = np.where(known, labels, model.posterior(masks))
        model = _maximised(votes, np.stack([1 - share, share], 1) * counts[:, None])
    return model


# --- classifier ----------------------------------------------------------------------

def own_columns(hits: list[list[int]]) -> np.ndarray:
    """Numbers of the terms (and of terms twice) that stand in enough sampled rows, ascending."""
    numbers, times = np.unique(np.concatenate([np.asarray(h, np.int64) for h in hits]), return_counts=True)
    return numbers[times >= LEAST_ROWS]


def features(hits: list[list[int]], masks: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """A column per term or term that stands there twice, per vote, and one of ones."""
    out = np.zeros((len(masks), len(columns) + VOTERS + 1), np.float32)
    place = {int(number): k for k, number in enumerate(columns)}
    for row, found in enumerate(hits):
        out[row, [place[k] for k in found if k in place]] = 1
    out[:, len(columns):-1] = bits_of(masks)
    out[:, -1] = 1
    return out


def fit_classifier(x: np.ndarray, target: np.ndarray, penalty: float = 0.5, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression on soft targets, by Newton's steps over distinct rows."""
    distinct, row_of = np.unique(np.packbits(x.astype(bool), axis=1), axis=0, return_inverse=True)
    row_of = row_of.ravel()
    first = np.zeros(len(distinct), int)
    first[row_of[::-1]] = np.arange(len(x))[::-1]
    counts = np.bincount(row_of)
    mean = np.bincount(row_of, target) / counts
    x = x[first].astype(np.float64)
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-4
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = counts * np.maximum(p * (1 - p), 1e-6)
        slope = x.T @ (counts * (mean - p)) - ridge * weights
        step = np.linalg.solve(x.T @ (x * curve[:, None]) + np.diag(ridge), slope)
        weights += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return weights


def scored(hits: DataFrame, n_terms: int, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` from stored hits, as built-in expressions.

    ``weights``: of every term, every term twice, every vote, and the constant.
    """
    # As one literal: an array of as many expressions would be slow to plan.
    term_weights = F.from_json(F.lit(json.dumps([float(w) for w in weights[:2 * n_terms]])), "array<double>")
    total = F.lit(float(weights[-1])) + F.aggregate(
        "hits", F.lit(0.0), lambda s, k: s + F.get(term_weights, k))
    for k in range(VOTERS):
        total = total + F.shiftright(F.col("votes"), k).bitwiseAND(F.lit(1)) * float(weights[2 * n_terms + k])
    return hits.select("doc_id", (1 / (1 + F.exp(-total))).alias("score"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, may_learn: Column, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, score`` of every row; only rows with ``may_learn`` lend their labels."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    learning = F.col("doc_id").isNotNull() & may_learn
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    # Labels grow with the texts, so they are never broadcast; the texts are shuffled once.
    labelled = stored(texts.where(learning).join(known.hint("merge"), "doc_id").select("text", "toxic"), "labelled")
    lexicon = mine_lexicon(labelled)
    log.info("%d terms in the lexicon", len(lexicon))
    if not lexicon:
        return texts.select("doc_id", F.lit(0.0).alias("score"))
    hits = stored(term_hits(docs, lexicon), "hits")
    seen = join_on(hits.withColumn("learning", learning), known, ["doc_id"]).withColumn(
        "label", F.when(F.col("learning"), F.coalesce("toxic", F.lit(-1))).otherwise(-1))
    counts = seen.groupBy("votes", "label").count().toPandas().sort_values(["votes", "label"])
    model = fit_label_model(counts["votes"].to_numpy(np.int64), counts["label"].to_numpy(np.int64),
                            counts["count"].to_numpy(float))
    chosen = least_hashes(hits.where(learning), sample, "doc_id").select("hits", "votes").toPandas()
    masks, found = chosen["votes"].to_numpy(np.int64), chosen["hits"].tolist()
    columns = own_columns(found)
    fitted = fit_classifier(features(found, masks, columns), model.posterior(masks))
    weights = np.zeros(2 * len(lexicon) + VOTERS + 1)
    weights[columns], weights[2 * len(lexicon):] = fitted[:len(columns)], fitted[len(columns):]
    return scored(hits, len(lexicon), weights)
