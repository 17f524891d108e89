"""Quality rules as a ledger: every rule is evaluated once per document and leaves a bit and its measurements.

``ledger`` measures each text in one pass. ``failures`` has bit k set where rule k fails. A policy is a named and
versioned set of rules; applying one, changing one, or asking what a rule costs only reads the ledger again.

* null text: no words, no lines; it fails the rules that an empty text fails;
* empty text: as null; rules on shares hold where there is nothing to share;
* very long text: measured whole; only short texts are measured several at a time;
* null or repeated ids: every row has its own ledger row;
* other columns: not looked at by ``ledger``; ``judged`` keeps all columns of its table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import WORD, portions

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


@dataclass(frozen=True)
class Rule:
    """A rule that fails where ``fails``, an SQL condition on whole-number measurements, is true."""

    name: str
    fails: str


# A rule's place is its bit; add rules at the end only.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("capitals", "2 * n_capitals > word_chars"),
)
BITS = {rule.name: 1 << k for k, rule in enumerate(RULES)}

# Versions of the policy: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(BITS),
}


def mask_of(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def _repeated(codes: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window of words that its text holds twice or more."""
    n = len(codes) - window + 1
    hit = np.zeros(len(codes), dtype=bool)
    if n < 2:
        return hit
    starts = np.flatnonzero(owner[:n] == owner[window - 1 :])
    # A hash tells nearly all windows apart; those that share one are compared word by word.
    mixed = owner.astype(np.uint64) + np.uint64(1)
    mixed = mixed[starts]
    for k in range(window):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[starts + k].astype(np.uint64)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    shared = np.zeros(len(starts), dtype=bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    starts = starts[shared]
    if not len(starts):
        return hit
    rows = np.column_stack([owner[starts], *[codes[starts + k] for k in range(window)]])
    _, which, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = starts[times[which.reshape(-1)] > 1]
    edges = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return np.cumsum(edges[:-1]) > 0


def _measured(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of texts without nulls."""
    n = len(texts)

    def per_text(owner, weights=None):
        return np.bincount(owner, weights, minlength=n).astype(np.int64)

    split = pc.split_pattern_regex(texts, SPACES)
    words, owner = pc.list_flatten(split), pc.list_parent_indices(split)
    real = pc.not_equal(words, "")
    words, owner = words.filter(real), owner.filter(real).to_numpy()
    lines_of = pc.split_pattern(texts, "\n")
    lines, line_owner = pc.list_flatten(lines_of), pc.list_parent_indices(lines_of)
    real = pc.match_substring_regex(lines, WORD)
    lines, line_owner = lines.filter(real), line_owner.filter(real).to_numpy()
    line_codes = lines.dictionary_encode().indices.to_numpy().astype(np.int64)
    distinct_lines = np.unique(line_owner.astype(np.int64) * (len(lines) + 1) + line_codes) // (len(lines) + 1)
    n_lines = per_text(line_owner)
    hit = _repeated(words.dictionary_encode().indices.to_numpy().astype(np.int64), owner, WINDOW)
    return {
        "n_words": per_text(owner),
        "word_chars": per_text(owner, pc.utf8_length(words).to_numpy()),
        "n_symbols": pc.count_substring_regex(texts, SYMBOLS).to_numpy().astype(np.int64),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - per_text(distinct_lines),
        "n_repeat_words": per_text(owner[hit]),
        "n_capitals": pc.count_substring_regex(texts, r"\p{Lu}").to_numpy().astype(np.int64),
    }


def measured(text: Column) -> Column:
    """A struct of the measurements of a text."""

    @F.arrow_udf(", ".join(f"{name} long" for name in MEASURES))
    def measure(column: pa.Array) -> pa.Array:
        texts = pc.fill_null(column, "")
        parts = [_measured(texts.slice(start, n)) for start, n in portions(texts)]
        arrays = [np.concatenate([p[name] for p in parts] or [np.empty(0, np.int64)]) for name in MEASURES]
        return pa.StructArray.from_arrays([pa.array(a) for a in arrays], names=list(MEASURES))

    return measure(text)


def failures(measures: str) -> Column:
    """The failure bits of a struct of measurements."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES):
        fields = rule.fails
        for name in MEASURES:
            fields = fields.replace(name, f"`{measures}`.{name}")
        bits = bits.bitwiseOR(F.when(F.expr(fields), F.lit(1 << k)).otherwise(0).cast("long"))
    return bits


def ledger(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: the id, the measurements and ``failures``."""
    rows = df.select(F.col(id_col), measured(F.col(text)).alias("m"))
    return rows.select(id_col, "m.*", failures("m").alias("failures"))


def passes(failed: Column, policy: str) -> Column:
    return failed.bitwiseAND(F.lit(mask_of(policy))) == 0


def kept(df: DataFrame, policy: str, text: str = "text") -> DataFrame:
    """The rows of ``df``, with its columns, that pass a policy."""
    names = df.columns
    inner = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text}`").alias("text"))
    judged = inner.select("row", measured(F.col("text")).alias("m"))
    return judged.where(passes(failures("m"), policy)).select("row.*")


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy costs, from the ledger alone: ``failing`` documents fail the rule, ``alone`` fail no
    other rule of the policy and would come back without it, ``kept_without`` is what the policy then keeps.

    Documents are first counted by their bits, of which there are at most two to the number of rules.
    """
    mask = mask_of(policy)
    counts = book.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BITS[n]).cast("long").alias("bit")) for n in POLICIES[policy]])
    each = counts.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    rest = F.col("bits").bitwiseAND(F.lit(mask) - F.col("bit"))

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        total(F.col("bits") == F.col("bit")).alias("alone"),
        total(rest == 0).alias("kept_without"),
    )
