"""Quality rules by a ledger of bits: every rule is evaluated once, policies are applied to what is stored.

`ledger` measures each text once and keeps the measurements with one integer, whose bit k is set if rule k fails.
A policy is a version with the bits that must not be set and, if wanted, bits of which a number may be set; it is
applied to a stored ledger by a bitwise test, without a text. `ablations` says from counts of equal integers what
each rule of a policy does: how many rows it fails, how many only it fails, and how many would be kept without it.

A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and carriage return. A null
or empty text has no word and one empty line; every measurement is 0, and the rules that then hold fail (too few
words). Repeated rows and null ids are rows like others. The ledger has the key columns asked for and its own;
other columns of the input, whatever their names, aren't in it.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskflow.llm.common import chunks, text_or_empty

WINDOW = 5
SYMBOLS = "#*$%&|<>"
_WORD = re.compile("[^ \t-\r]+")
#: From the first letter of a word to its end, so once for each word with a letter.
_LETTERED = re.compile("[^\\W\\d_][^ \t-\r]*")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lettered")

#: name, condition under which a text fails. The place is the bit, so new rules are added at the end.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("few_letters", "10 * n_lettered < 8 * n_words"),
)
BITS = {name: 1 << k for k, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BITS[n] for n in set(names))


@dataclass(frozen=True)
class Policy:
    """Keeps rows that fail none of `required` and at most `limit` of `tolerated`."""

    version: int
    required: int
    tolerated: int = 0
    limit: int = 0

    def keeps(self, failures: str | Column = "failures") -> Column:
        bits = F.col(failures) if isinstance(failures, str) else failures
        few = F.bit_count(bits.bitwiseAND(F.lit(self.tolerated))) <= self.limit
        return (bits.bitwiseAND(F.lit(self.required)) == 0) & few


BASE = mask("few_words", "repeated_words")
POLICIES = {
    1: Policy(1, BASE),
    2: Policy(2, BASE | mask("symbols"), mask("short_words", "long_words", "duplicate_lines", "few_letters"), 1),
    3: Policy(3, mask(*BITS)),
}
CURRENT = 2


def _repeated(words: list[str]) -> int:
    """Words covered by windows that occur at least twice. Words are numbered, so that equality is exact."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if n == len(numbers) - WINDOW + 1:
        return 0  # no word occurs twice
    key = codes[:n]
    for k in range(1, WINDOW):
        # The window's first k words as one number below n, then one word more: less than n * n in all.
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(numbers) + codes[k : n + k]
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    ends = np.zeros(len(words) + 1, np.int64)
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(ends[:-1])))


def measure(text: str) -> tuple[int, ...]:
    """The numbers named in MEASURES."""
    words = _WORD.findall(text)
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        len(_LETTERED.findall(text)),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in chunks(batch, "__text"):
            found = np.array([measure(t.as_py()) for t in rows.column("__text")], np.int64).reshape(-1, len(MEASURES))
            keys = [rows.column(i) for i in range(rows.num_columns - 1)]
            names = rows.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(found[:, k]) for k in range(len(MEASURES)))], [*names, *MEASURES])


def failures() -> Column:
    """One integer for the measurements of a row: bit k is set if rule k fails."""
    bits = [F.when(F.expr(condition), F.lit(BITS[name])).otherwise(0) for name, condition in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total.cast("long")


def ledger(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The key columns, the measurements and `failures` for each row. Keys may not have names of the ledger."""
    if taken := {*keys} & {*MEASURES, "failures"}:
        raise ValueError(f"key columns with names of the ledger: {', '.join(sorted(taken))}")
    rows = docs.select(*keys, text_or_empty(text).alias("__text"))
    schema = StructType([*rows.schema.fields[:-1], *(StructField(m, LongType(), False) for m in MEASURES)])
    return rows.mapInArrow(_measured, schema).withColumn("failures", failures())


def apply_policy(stored: DataFrame, version: int = CURRENT) -> DataFrame:
    """A stored ledger with `kept` and `policy`, the version."""
    policy = POLICIES[version]
    return stored.withColumns({"kept": policy.keeps(), "policy": F.lit(policy.version)})


def ablations(stored: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of the policy: n_failed, n_only (rows failing no other rule of it), n_kept and n_kept_without it.

    Rows are counted for each distinct integer first, of which there are few (at most 2 to the number of rules,
    whatever the rows are); what follows reads only these counts. An empty ledger has zeros.
    """
    policy = POLICIES[version]
    used = policy.required | policy.tolerated
    names = [n for n, bit in BITS.items() if bit & used]
    counts = stored.groupBy(F.col("failures").bitwiseAND(F.lit(used)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    per_rule = []
    for name in names:
        bit = F.lit(BITS[name])
        fails = F.col("bits").bitwiseAND(bit) != 0
        without = F.col("bits").bitwiseAND(F.lit(used & ~BITS[name]))
        per_rule.append(
            F.struct(
                F.lit(name).alias("rule"),
                total(fails).alias("n_failed"),
                total(F.col("bits") == bit).alias("n_only"),
                total(policy.keeps(F.col("bits"))).alias("n_kept"),
                total(policy.keeps(without)).alias("n_kept_without"),
            )
        )
    return counts.agg(F.array(*per_rule).alias("rules")).select(F.inline("rules"))
