"""Rewording of corpora: output wrappers, glossary terms, nullability notes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Instructions of the output wrappers, with what goes before and after the query.
WRAPPERS = {
    "json_sql": 'Output format: respond with a JSON object of the form {"sql": "<query>"} and nothing else.',
    "json_query": 'Output format: respond with a JSON object of the form {"query": "<query>"} and nothing else.',
    "json_dialect": 'Output format: respond as JSON, {"dialect": "%s", "sql": "<query>"}, and nothing else.',
    "fenced": "Output format: return the query inside a ```sql fenced block and nothing else.",
    "tags": "Output format: put the query between <sql> and </sql> tags and nothing else.",
}
#: Name of the dialect in the wrapper that states one.
DIALECT = "tidemark"


def wrapped(sql: Column, kind: Column, dialect: str = DIALECT) -> Column:
    """The query in its wrapper; as it is for a null kind."""
    as_json = lambda k: F.to_json(F.struct(sql.alias(k)))
    named = F.to_json(F.struct(F.lit(dialect).alias("dialect"), sql.alias("sql")))
    return (F.when(kind == "json_sql", as_json("sql")).when(kind == "json_query", as_json("query")).when(kind == "json_dialect", named)
            .when(kind == "fenced", F.concat(F.lit("```sql\n"), sql, F.lit("\n```"))).when(kind == "tags", F.concat(F.lit("<sql>\n"), sql, F.lit("\n</sql>"))).otherwise(sql))


def with_wrappers(df: DataFrame, sql: str, order: str, share: float = 0.1, seed: int = 1, eligible: Column | None = None, dialect: str = DIALECT) -> DataFrame:
    """Adds ``wrapper``, ``instruction`` and ``answer``: about ``share`` of the eligible rows, by hash, get a wrapper."""
    h = F.pmod(F.xxhash64(F.lit(seed), F.col(order)), F.lit(1_000_000))
    kinds = F.array(*map(F.lit, WRAPPERS))
    kind = F.when((h < int(share * 1_000_000)) & (F.lit(True) if eligible is None else eligible), F.element_at(kinds, (F.pmod(F.xxhash64(F.lit(seed + 1), F.col(order)), F.lit(len(WRAPPERS))) + 1).cast("int")))
    notes = F.create_map(*[F.lit(x) for name, note in WRAPPERS.items() for x in (name, note % dialect if name == "json_dialect" else note)])
    return df.withColumn("wrapper", kind).withColumn("instruction", F.try_element_at(notes, F.col("wrapper"))).withColumn("answer", wrapped(F.col(sql), F.col("wrapper"), dialect))


def substitute_term(text: Column, old: str, new: str) -> Column:
    """The text with a term replaced, whatever its capitals; what is added to its last word stays.

    The term may also stand shortened, with words in its middle left out. A
    capital goes over to the new term, and an indefinite article before it
    becomes the one that the new term takes.
    """
    first, *rest = map(re.escape, old.split())
    optional = "".join(rf"(?:\s+{w})?" for w in rest[:-1])
    body = first + optional + (rf"\s+{rest[-1]}" if rest else "")
    sound = "an" if new[:1].lower() in tuple("aeiou") else "a"
    quote = lambda t: t.replace("\\", "\\\\").replace("$", "\\$")
    # four cases: the article's capital, none, and the term's own capital
    for article, put in (("A", sound.capitalize() + "$1"), ("a", sound + "$1"), (None, "")):
        for upper in (True, False):
            lead = rf"\b(?-i:{article})n?(\s+)" if article else r"\b()"
            case = f"(?={'[A-Z]' if upper else '[^A-Z]'})"
            pattern = rf"(?i){lead}(?-i:{case})({body})((?:e?s)?(?:'s)?)(?!\w)"
            value = new[:1].upper() + new[1:] if upper else new
            text = F.regexp_replace(text, pattern, put + quote(value) + "$3")
    return text


def renullable(columns: DataFrame, row: str = "row_id", low: float = 0.6, high: float = 0.8, seed: int = 1, used_weight: float = 2.0) -> DataFrame:
    """Columns of tables with ``nullable`` switched on for a share of each table's columns.

    ``columns`` is (row, column, is_time, nullable, protected, used). The share
    lies between ``low`` and ``high``, by hash of the row; which columns switch is
    a weighted draw by hash, in which used ones count ``used_weight``. Time,
    protected and already nullable columns stay as they are.
    """
    unit = lambda *c: (F.pmod(F.xxhash64(F.lit(seed), *c), F.lit(1_000_003)).cast("double") + 0.5) / 1_000_003
    plain = ~F.col("is_time")
    per = Window.partitionBy(row)
    wanted = F.round((low + (high - low) * unit(F.col(row))) * F.sum(plain.cast("int")).over(per)) - F.sum((plain & F.col("nullable")).cast("int")).over(per)
    free = plain & ~F.col("nullable") & ~F.col("protected")
    key = -F.log(unit(F.col(row), F.col("column"))) / F.when(F.col("used"), used_weight).otherwise(1.0)  # smallest keys: a weighted draw
    place = F.row_number().over(Window.partitionBy(row, "_free").orderBy("_key", "column"))
    out = columns.withColumn("_wanted", wanted).withColumn("_free", free).withColumn("_key", key).withColumn("_place", place)
    return out.withColumn("nullable", F.col("nullable") | (F.col("_free") & (F.col("_place") <= F.col("_wanted")))).drop("_wanted", "_free", "_key", "_place")
