"""The engine: a catalog of time-series tables and a dialect over Spark SQL."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, TimestampNTZType, TimestampType

from .dialect.checks import check_tokens
from .dialect.errors import Lint, QueryError
from .dialect.rewrite import Context, Rewriter
from .dialect.tokens import Token, closing, render, split_on, tokenize
from .functions.definitions import install
from .sources.extern import read_extern

#: Settings of the dialect's own session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.groupByAliases": "false",
}
#: Lookups up to this size become map literals; larger ones are tables, which Spark joins.
LOOKUP_LITERALS = 1000
TIME = "__time"


class Engine:
    """Tables, lookups and a clock; :meth:`sql` runs a query of the dialect.

    The engine works in a session of its own, with the dialect's settings,
    functions and views; the caller's session is left as it is.
    """

    def __init__(self, spark: SparkSession, as_of: str | None = None):
        self.spark = spark.newSession()
        for key, value in SETTINGS.items():
            self.spark.conf.set(key, value)
        install(self.spark)
        self.as_of = as_of
        self.tables: dict[str, DataFrame] = {}
        self.lookups: dict[str, dict[str, str] | str] = {}

    def register(self, name: str, source: DataFrame | str, time_column: str | None = None, metadata: dict[str, dict] | None = None) -> DataFrame:
        """Make a table of a DataFrame or a Parquet path.

        ``time_column`` is renamed to ``__time``; timestamps without a zone are
        taken as UTC. Arrays of strings are multi-value columns. ``metadata``
        (role, polarity, encoding) is kept with the columns.
        """
        if isinstance(source, str):
            df = self.spark.read.parquet(source)
        else:
            hidden = f"tidemark_{id(self)}_{len(self.tables)}"
            source.createOrReplaceGlobalTempView(hidden)
            df = self.spark.table(f"global_temp.{hidden}")
        columns = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, TimestampNTZType):
                c = c.cast("timestamp")
            about = dict(f.metadata) | (metadata or {}).get(f.name, {})
            if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
                about["mvd"] = True
            columns.append(c.alias(TIME if f.name == time_column else f.name, metadata=about))
        df = df.select(*columns)
        if time_column and not isinstance(df.schema[TIME].dataType, TimestampType):
            raise ValueError(f"{time_column!r} of {name!r} is no timestamp")
        df.createOrReplaceTempView(name)
        self.tables[name.lower()] = df
        return df

    def drop(self, name: str) -> bool:
        """Forget a table; False if there is none."""
        self.spark.catalog.dropTempView(name)
        return self.tables.pop(name.lower(), None) is not None

    def register_lookup(self, name: str, mapping: dict[str, str] | DataFrame) -> None:
        """Register a key to value map, or a ``(k, v)`` table, for ``LOOKUP(column, name)``.

        Of a table's equal keys the greatest value counts.
        """
        if isinstance(mapping, dict) and len(mapping) <= LOOKUP_LITERALS:
            self.lookups[name] = {str(k): str(v) for k, v in mapping.items() if v is not None}
            return
        view = f"lookup__{len(self.lookups)}_{re.sub('[^A-Za-z0-9]', '_', name).lower()}"
        if isinstance(mapping, dict):
            table = self.spark.createDataFrame([(str(k), v if v is None else str(v)) for k, v in mapping.items()], "k string, v string")
        else:
            hidden = f"tidemark_{id(self)}_{view}"
            mapping.select(F.col("k").cast("string"), F.col("v").cast("string")).createOrReplaceGlobalTempView(hidden)
            table = self.spark.table(f"global_temp.{hidden}").groupBy("k").agg(F.max_by("v", "v").alias("v"))
        table.createOrReplaceTempView(view)
        self.lookups[name] = view

    def _context(self, tokens: list[Token]) -> Context:
        used = {t.name.lower(): df for t in tokens if t.is_name and (df := self.tables.get(t.name.lower())) is not None}
        columns = {name: {f.name.lower(): (f.dataType.simpleString(), bool(f.metadata.get("mvd"))) for f in df.schema.fields} for name, df in used.items()}
        return Context(self.as_of, columns, self.lookups, self._columns_of)

    def _columns_of(self, text: str) -> list[tuple[str, str]] | None:
        """Names, lower-cased, and types of the columns of a query of Spark, which is analyzed and not run; None if it can't be."""
        try:
            return [(f.name.lower(), f.dataType.simpleString()) for f in self.spark.sql(text).schema.fields]
        except Exception:  # parsing, analysis: the whole query will say what is wrong
            return None

    def translate(self, query: str) -> tuple[str, list[Lint]]:
        """Spark SQL for a query, and lints; raises QueryError where it is rejected."""
        tokens = tokenize(query)
        lints = check_tokens(tokens, set(self.lookups))
        rewriter = Rewriter(self._context(tokens))
        text = render(rewriter.query(tokens))
        return text, lints + rewriter.lints + _column_lints(tokens, self.tables)

    def _with_externs(self, query: str) -> str:
        """The query with a table in place of each ``TABLE(EXTERN(source, format, signature))``."""
        if "EXTERN" not in query.upper():
            return query
        tokens, out, k = tokenize(query), [], 0
        while k < len(tokens):
            if [t.upper for t in tokens[k : k + 4]] != ["TABLE", "(", "EXTERN", "("]:
                out.append(tokens[k])
                k += 1
                continue
            end = closing(tokens, k + 3)
            args = split_on(tokens[k + 4 : end])
            if len(args) != 3 or any(len(a) != 1 or a[0].kind != "string" for a in args):
                raise QueryError("S9", "EXTERN takes three texts: source, format and signature")
            name = f"extern__{hashlib.sha1(render(tokens[k:end]).encode()).hexdigest()[:16]}"
            if name not in self.tables:
                self.register(name, read_extern(self.spark, *[a[0].name for a in args]))
            out.append(Token("word", name))
            k = closing(tokens, k + 1) + 1
        return render(out)

    def sql(self, query: str) -> DataFrame:
        """Run a query of the dialect. Errors of Spark become QueryErrors."""
        query = self._with_externs(query)
        text, _ = self.translate(query)
        if "information_schema_" in text:
            self._information_schema()
        tokens = tokenize(query)
        try:
            df = self.spark.sql(text)
        except Exception as e:
            raise as_query_error(e, self._ungrouped(tokens)) from e
        if any(t.upper in ("MIN", "MAX") for t in tokens):
            _check_extremes(df)
        return df

    def _ungrouped(self, tokens: list[Token]) -> set[str]:
        """Columns of the query's tables, lower-cased, if it groups: such a column that Spark can't find isn't grouped."""
        if not any(t.upper == "GROUP" for t in tokens):
            return set()
        return {c.lower() for t in tokens if t.is_name and (df := self.tables.get(t.name.lower())) is not None for c in df.columns}

    def _information_schema(self) -> None:
        rows = [(n, f.name, k + 1, f.dataType.simpleString().upper(), "YES" if f.nullable else "NO") for n, df in sorted(self.tables.items()) for k, f in enumerate(df.schema.fields)]
        columns = self.spark.createDataFrame(rows, "TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, DATA_TYPE string, IS_NULLABLE string")
        columns.createOrReplaceTempView("information_schema_columns")
        columns.select("TABLE_NAME").distinct().createOrReplaceTempView("information_schema_tables")

    def inspect(self, name: str) -> dict:
        """Columns, types and row count of a table."""
        df = self.tables[name.lower()]
        return {"name": name, "columns": [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "rows": df.count()}


def join_lookup(df: DataFrame, column: str, lookup: DataFrame, name: str = "value") -> DataFrame:
    """``df`` with the value of a ``(k, v)`` lookup table; null for missing keys.

    Keys are made unique by their smallest value, so that rows never multiply;
    whether the table is broadcast follows from its size.
    """
    table = lookup.groupBy(F.col("k").alias("_k")).agg(F.min("v").alias(name))
    return df.join(table, df[column] == F.col("_k"), "left").drop("_k")


def _check_extremes(df: DataFrame) -> None:
    """C9: MIN and MAX of text, whatever expression it is, by the types of the analyzed plan."""
    plans = [df._jdf.queryExecution().analyzed()]
    while plans:
        plan = plans.pop()
        plans += [plan.children().apply(k) for k in range(plan.children().size())]
        if plan.nodeName() not in ("Aggregate", "Window"):
            continue
        found = [plan.expressions().apply(k) for k in range(plan.expressions().size())]
        while found:
            e = found.pop()
            if e.nodeName() in ("Max", "Min") and e.dataType().typeName() == "string":
                raise QueryError("C9", f"Aggregation [{e.nodeName().upper()}] does not support type [STRING]")
            found += [e.children().apply(k) for k in range(e.children().size())]


def _column_lints(tokens: list[Token], tables: dict[str, DataFrame]) -> list[Lint]:
    """Epoch seconds taken as milliseconds, and ranges of encoded times."""
    encodings = {f.name.lower(): f.metadata["encoding"] for t in tokens if t.is_name and (df := tables.get(t.name.lower())) is not None for f in df.schema.fields if "encoding" in f.metadata}
    out = []
    for k, t in enumerate(tokens):
        encoding = encodings.get(t.name.lower()) if t.is_name else None
        after = tokens[k + 1 : k + 3]
        if encoding == "epoch_s" and k > 1 and tokens[k - 2].upper == "MILLIS_TO_TIMESTAMP" and not (after and after[0].text == "*"):
            out.append(Lint("L2", f"{t.name} holds seconds: multiply by 1000"))
        if encoding and after and after[0].upper == "BETWEEN" and len(after) > 1 and after[1].upper in ("TIMESTAMP", "CURRENT_TIMESTAMP"):
            out.append(Lint("L3", f"{t.name} is no timestamp: the range compares text or numbers"))
    return out


_MESSAGES = (
    (r"MISSING_AGGREGATION\][^\"]*\"(?:[^\"]*\.)?([^\"]+)\"", "Expression '{0}' is not being grouped"),
    (r"UNRESOLVED_COLUMN[^`]*`(?:[^`]+`\.`)*([^`]+)`", "Column '{0}' not found in any table"),
    (r"TABLE_OR_VIEW_NOT_FOUND[^`]*`(?:[^`]+`\.`)*([^`]+)`", "Object '{0}' not found"),
    (r"UNRESOLVED_ROUTINE[^`]*`(?:[^`]+`\.`)*([^`]+)`", "No match found for function signature {0}"),
    (r"NESTED_AGGREGATE_FUNCTION", "Aggregate expressions cannot be nested"),
)


def as_query_error(e: Exception, ungrouped: set[str] = frozenset()) -> QueryError:
    """The dialect's wording of an error of Spark; else its first line.

    ``ungrouped`` are columns, lower-cased, that can only be missing because the query groups.
    """
    text = str(e)
    missing = re.search(r"UNRESOLVED_COLUMN[^`]*`(?:[^`]+`\.`)*([^`]+)`", text, re.S)
    if missing and missing[1].lower() in ungrouped:
        return QueryError(type(e).__name__, f"Expression '{missing[1]}' is not being grouped")
    for pattern, message in _MESSAGES:
        if m := re.search(pattern, text, re.S):
            return QueryError(type(e).__name__, message.format(*m.groups()))
    return QueryError(type(e).__name__, text.strip().splitlines()[0][:500] if text.strip() else type(e).__name__)
