"""Mixing sources to target weights (problem 7).

Every document has a hash; a source is cut by a threshold on it. Tokens are
summed by source and hash bucket, pre-aggregated where they are counted; the
bucket that a budget falls into is the only one refined, by the next bits of
the hash, until single hashes remain. Drawing is then a filter: no sort, no
shuffle of documents, and a smaller budget's draw is part of a larger one's.

Defined results: a source without target, or with a null one, isn't drawn; a
target without documents stays unreached, is reported with share 0, and the
others keep their proportions; null and empty texts have no tokens and aren't
drawn; documents with equal ids have equal hashes and are drawn together.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.session import cut

#: The largest number of sources with targets; thresholds of all are held by the driver.
MOST_SOURCES = 5_000
#: Bits of the hash that one round of histograms resolves, and rounds.
BITS, ROUNDS = 8, 7

#: Where the public tokenizer's vocabulary lies; a parameter of ``token_sizes``.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The largest vocabulary file that is sent to every executor.
MOST_VOCABULARY = 64 << 20
#: Fixed value: the splitting pattern of byte-level BPE vocabularies of 50k entries.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def token_sizes(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, seed: int = 42) -> DataFrame:
    """(doc_id, source, n_tokens, h): tokens of each text, and its hash of 56 bits.

    vocabulary: a path on the driver; the file, of ``MOST_VOCABULARY`` bytes at most, travels to the executors.
    """
    made: list = []
    with open(vocabulary, "rb") as f:
        body = f.read(MOST_VOCABULARY + 1)
    if len(body) > MOST_VOCABULARY:
        raise ValueError(f"a vocabulary of more than {MOST_VOCABULARY} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(body)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not made:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in sent.value.splitlines() if line.strip())}
            made.append(tiktoken.Encoding("mixing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))
        enc = made[0]
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "n_tokens": [len(enc.encode_ordinary(t)) if t else 0 for t in pdf["text"]], "h": pdf["h"]})

    h = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(seed)), 8)
    src = docs.where("doc_id is not null and source is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", F.col("text"), h.alias("h"))
    return src.mapInPandas(run, "doc_id bigint, source string, n_tokens bigint, h bigint")


@dataclass
class Plan:
    """What of each source a budget draws: ``full`` copies of all, one more below ``threshold``."""

    budget: int
    tokens: dict[str, int]
    shares: dict[str, float]
    caps: dict[str, int]
    full: dict[str, int]
    threshold: dict[str, int]


def largest_budget(tokens: dict[str, int], shares: dict[str, float], caps: dict[str, int]) -> int:
    """The most tokens of a mix in which every source with documents has its share within its cap."""
    there = {s: w for s, w in shares.items() if w > 0 and tokens.get(s, 0) > 0}
    total = sum(Fraction(w) for w in there.values())
    return int(min((caps[s] * tokens[s] / (Fraction(w) / total) for s, w in there.items()), default=0))


def plan_mix(sizes: DataFrame, targets: list[tuple[str, float, int]], parts: tuple[float, ...] = (1.0,)) -> list[Plan]:
    """Thresholds of nested budgets: the given parts of the largest budget. ``sizes`` is read once a round.

    A source that may be drawn 0 times, or has no documents, is left out and its share falls to the others; without a
    cap a source is drawn once.
    """
    if len(targets) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    shares = {s: float(w) for s, w, _ in targets if s is not None and w is not None and w > 0}
    caps = {s: 1 if c is None else max(int(c), 0) for s, w, c in targets if s in shares}
    wanted = F.col("source").isin(list(shares)) & (F.col("n_tokens") > 0)
    own = sizes.where(wanted)
    tokens = {r[0]: int(r[1]) for r in own.groupBy("source").agg(F.sum("n_tokens")).collect() if caps[r[0]]} if shares else {}
    most = largest_budget(tokens, shares, caps)
    total = sum(w for s, w in shares.items() if tokens.get(s))
    plans = []
    cuts: dict[tuple[int, str], tuple[int, int]] = {}  # (plan, source) -> (prefix of the hash found so far, tokens still to draw)
    for k, part in enumerate(sorted(parts)):
        budget = int(most * part)
        plan = Plan(budget, tokens, shares, caps, {}, {})
        for s in shares:
            need = round(budget * shares[s] / total) if tokens.get(s) else 0
            plan.full[s] = min(need // tokens[s], caps[s]) if tokens.get(s) else 0
            rest = need - plan.full[s] * tokens[s] if tokens.get(s) else 0
            plan.threshold[s] = 0
            if rest > 0 and plan.full[s] < caps[s]:
                cuts[k, s] = (0, rest)
        plans.append(plan)
    for level in range(1, ROUNDS + 1):
        if not cuts:
            break
        shift = BITS * (ROUNDS - level)
        open_ = sorted({(s, p) for (_, s), (p, _) in cuts.items()})
        at = sizes.sparkSession.createDataFrame(open_, T.StructType([T.StructField("source", T.StringType()), T.StructField("prefix", T.LongType())]))
        bucket = F.shiftright("h", shift)
        # at most 256 buckets of each open bucket come back
        rows = own.withColumn("prefix", F.shiftright("h", shift + BITS)).join(F.broadcast(at), ["source", "prefix"]).groupBy("source", "prefix", bucket.alias("bucket")).agg(F.sum("n_tokens").alias("n")).collect()
        by: dict[tuple[str, int], list[tuple[int, int]]] = {}
        for r in rows:
            by.setdefault((r["source"], r["prefix"]), []).append((int(r["bucket"]), int(r["n"])))
        for (k, s), (prefix, rest) in list(cuts.items()):
            for b, n in sorted(by.get((s, prefix), [])):
                if n > rest:
                    break
                rest -= n
            else:
                plans[k].threshold[s] = (prefix + 1) << (shift + BITS)
                del cuts[k, s]
                continue
            if level == ROUNDS or rest == 0:
                # a single hash is left: it is drawn if that comes nearer
                plans[k].threshold[s] = (b + (1 if level == ROUNDS and n - rest < rest else 0)) << shift
                del cuts[k, s]
            else:
                cuts[k, s] = (b, rest)
    return plans


def draw(sizes: DataFrame, plan: Plan) -> DataFrame:
    """(doc_id, source, n_tokens, repeats) of all documents drawn."""
    rows = [(s, plan.full[s], plan.threshold[s]) for s in plan.shares]
    if not rows:
        return sizes.where("false").select("doc_id", "source", "n_tokens", F.lit(0).alias("repeats"))
    t = sizes.sparkSession.createDataFrame(rows, "source string, full int, threshold bigint")
    copies = F.col("full") + (F.col("h") < F.col("threshold")).cast("int")
    return sizes.where("n_tokens > 0").join(F.broadcast(t), "source").select("doc_id", "source", "n_tokens", copies.alias("repeats")).where("repeats > 0")


def report(sizes: DataFrame, targets: list[tuple[str, float, int]], plans: list[Plan]) -> DataFrame:
    """One row a budget and target source: its tokens, target and actual share, most repeats, documents drawn."""
    spark = sizes.sparkSession
    schema = "budget bigint, source string, target_share double, max_repeats int, source_tokens bigint, drawn_tokens bigint, drawn_documents bigint, most_repeats int, actual_share double"
    rows = []
    for p in plans:
        got = {r["source"]: r for r in draw(sizes, p).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("t"), F.count("*").alias("n"), F.max("repeats").alias("m")).collect()}
        total = sum(int(r["t"]) for r in got.values())
        for s, w, c in targets:
            r = got.get(s)
            rows.append((p.budget, s, w, c, p.tokens.get(s, 0), int(r["t"]) if r else 0, int(r["n"]) if r else 0, int(r["m"]) if r else 0, int(r["t"]) / total if r and total else 0.0))
    return spark.createDataFrame(rows, schema)


def sized(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``token_sizes``, tokenized once and kept in the shared folder."""
    return cut(token_sizes(docs, vocabulary))
