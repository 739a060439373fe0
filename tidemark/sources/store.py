"""Loading declared tables into an engine, statements that write, and sinks for results."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dialect.errors import QueryError
from ..dialect.tokens import Token, find_top, render, tokenize
from ..engine import TIME, Engine
from .extern import read_extern
from .spec import Spec, read_seed, spec_fingerprint

#: Granularities of PARTITIONED BY, and the parts of a date that they keep apart.
PARTS = {"ALL": None, "HOUR": "yyyy-MM-dd-HH", "DAY": "yyyy-MM-dd", "MONTH": "yyyy-MM", "YEAR": "yyyy"}
_PART = "part__"


class Store:
    """Tables of an engine that are kept as Parquet below a folder.

    A write goes to a folder of its own, and the manifest, which names each
    table's current folder, then changes in one rename: readers see the old rows
    or the new ones, a failed write changes nothing, and a table may be replaced
    from itself. The folder before the current one is kept for queries that still
    read it. A store opened on a folder has the tables of its manifest; stores that
    write different tables of one folder keep each other's entries, unless two
    manifests are renamed at the same moment.
    """

    def __init__(self, engine: Engine, folder: str):
        self.engine, self.folder = engine, folder.rstrip("/")
        self._jvm = engine.spark._jvm.org.apache.hadoop.fs
        self._fs = self._jvm.Path(self.folder).getFileSystem(engine.spark._jsparkSession.sessionState().newHadoopConf())
        self.manifest: dict[str, dict] = self._read_manifest()
        for name, entry in self.manifest.items():
            self._register(name, entry["path"])

    def _read_manifest(self) -> dict[str, dict]:
        path = self._jvm.Path(f"{self.folder}/manifest.json")
        if not self._fs.exists(path):
            return {}
        return json.loads("\n".join(r[0] for r in self.engine.spark.read.text(path.toString()).collect()))

    def _save_manifest(self, key: str, entry: dict | None) -> None:
        """Change one table's entry (None: remove it) in the manifest as it is now, whoever wrote it last."""
        self.manifest = self._read_manifest()
        self.manifest.pop(key, None)
        if entry:
            self.manifest[key] = entry
        jvm, new = self.engine.spark._jvm, self._jvm.Path(f"{self.folder}/manifest.{uuid.uuid4().hex}")
        out = self._fs.create(new, True)
        try:
            out.write(json.dumps(self.manifest).encode())
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
        options = self.engine.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "OVERWRITE")
        context.rename(new, self._jvm.Path(f"{self.folder}/manifest.json"), options)

    def _register(self, name: str, path: str) -> None:
        df = self.engine.spark.read.parquet(path)
        self.engine.register(name, df.drop(_PART))

    def insert(self, name: str, df: DataFrame, replace: bool = False, parts: str = "ALL", mark: str | None = None) -> None:
        """Write a new table; with ``replace`` in place of an old one, else an error if it exists."""
        key = name.lower()
        if not replace and key in self.engine.tables:
            raise QueryError("S10", f"Table {name!r} exists already; use REPLACE")
        if parts not in PARTS or (PARTS[parts] and TIME not in df.columns):
            raise QueryError("S10", f"can't partition by {parts}: it must be one of {', '.join(PARTS)}, of a table with {TIME}")
        path = f"{self.folder}/{key}/{uuid.uuid4().hex}"
        if PARTS[parts]:
            df.withColumn(_PART, F.date_format(TIME, PARTS[parts])).write.partitionBy(_PART).parquet(path)
        else:
            df.write.parquet(path)
        old = self._read_manifest().get(key, {})
        self._save_manifest(key, {"path": path, "before": old.get("path"), "mark": mark})
        self._register(name, path)
        if old.get("before"):
            self._fs.delete(self._jvm.Path(old["before"]), True)

    def drop(self, name: str) -> bool:
        """Forget a table and remove its files; False if there is none."""
        known = self.engine.drop(name)
        if name.lower() in self._read_manifest():
            self._save_manifest(name.lower(), None)
            self._fs.delete(self._jvm.Path(f"{self.folder}/{name.lower()}"), True)
            known = True
        return known

    def execute(self, statement: str) -> DataFrame | None:
        """Run a statement: INSERT INTO, REPLACE INTO .. OVERWRITE ALL, DROP TABLE; else a query, whose rows come back.

        Both writes end in ``PARTITIONED BY ALL [TIME]`` or a granularity of time;
        ``CLUSTERED BY`` after that sorts the files by the columns named.
        """
        tokens = tokenize(statement)
        first = tokens[0].upper if tokens else ""
        if first == "DROP":
            return self._drop(tokens)
        if first not in ("INSERT", "REPLACE"):
            return self.engine.sql(statement)
        if len(tokens) < 4 or tokens[1].upper != "INTO" or not tokens[2].is_name:
            raise QueryError("SYNTAX", f"{first} INTO takes the name of a table")
        at = 3
        if first == "REPLACE":
            if [t.upper for t in tokens[3:5]] != ["OVERWRITE", "ALL"]:
                raise QueryError("SYNTAX", "REPLACE takes OVERWRITE ALL")
            at = 5
        end = find_top(tokens, ("PARTITIONED",), at)
        if end < 0:
            raise QueryError("SYNTAX", f"{first} needs PARTITIONED BY")
        grain = [t.upper for t in tokens[end + 2 :]]
        cut = grain.index("CLUSTERED") if "CLUSTERED" in grain else len(grain)
        keys = [t.name for t in tokens[end + 2 + cut + 2 :] if t.is_name]
        if tokens[end + 1].upper != "BY" or grain[:cut] not in (["ALL"], ["ALL", "TIME"], *([g] for g in PARTS)):
            raise QueryError("SYNTAX", f"PARTITIONED BY takes ALL, ALL TIME or one of {', '.join(PARTS)}")
        df = self.engine.sql(render(tokens[at:end]))
        unknown = [k for k in keys if k not in df.columns]
        if unknown:
            raise QueryError("S10", f"CLUSTERED BY {unknown[0]}: the query has no such column")
        self.insert(tokens[2].name, df.sortWithinPartitions(*keys) if keys else df, first == "REPLACE", grain[0])
        return None

    def _drop(self, tokens: list[Token]) -> None:
        words = [t.upper for t in tokens]
        lenient = words[2:4] == ["IF", "EXISTS"]
        names = tokens[4 if lenient else 2 :]
        if words[1:2] != ["TABLE"] or len(names) != 1 or not names[0].is_name:
            raise QueryError("SYNTAX", "DROP TABLE [IF EXISTS] takes the name of a table")
        if not self.drop(names[0].name) and not lenient:
            raise QueryError("S12", f"Object '{names[0].name}' not found")

    def load(self, spec: Spec, force: bool = False) -> bool:
        """Load a declared table; False if it is unchanged since the last load, by whatever process."""
        mark = spec_fingerprint(spec)
        if self.manifest.get(spec.name.lower(), {}).get("mark") == mark and not force:
            return False
        self.insert(spec.name, read_seed(self.engine.spark, spec), replace=True, mark=mark)
        return True

    def verify(self, name: str, recent_days: int = 14) -> dict:
        """:func:`verified` of a table of the engine, as a dictionary."""
        return verified(self.engine.tables[name.lower()], self.engine.as_of, recent_days).first().asDict()


def verified(df: DataFrame, as_of: str | None = None, recent_days: int = 14) -> DataFrame:
    """One row on a loaded table, in one pass: row count, time range, nulls by column,
    empty rows of multi-value columns, malformed ones among the JSON-like texts, and whether
    the last time lies within ``recent_days`` of the clock."""
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    aggs = [F.count("*").alias("rows"), F.min(TIME).alias("first_time"), F.max(TIME).alias("last_time"),
            F.coalesce(F.max(TIME) >= now - F.expr(f"INTERVAL '{int(recent_days)}' DAY"), F.lit(False)).alias("recent")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls:{c}") for c in df.columns]
    aggs += [F.count_if(F.size(f"`{f.name}`") == 0).alias(f"empty:{f.name}") for f in df.schema.fields if f.metadata.get("mvd")]
    for name in (n for n, t in df.dtypes if t == "string"):
        c = F.col(f"`{name}`")
        aggs.append(F.count_if(F.ltrim(c).rlike(r"^[{\[]") & F.try_parse_json(c).isNull()).alias(f"malformed:{name}"))
    return df.agg(*aggs)


def require_unique(df: DataFrame, key: str, name: str = "table") -> DataFrame:
    """``df`` itself if no key occurs twice, so that a join with it can't multiply rows; else an error. Null keys never join."""
    twice = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{name}: key {key} = {twice[0][0]!r} occurs {twice[0][1]} times")
    return df


def extern_table(engine: Engine, name: str, source: str, fmt: str, signature: str) -> DataFrame:
    """A named table of an external source; see :func:`tidemark.sources.extern.read_extern`."""
    return engine.register(name, read_extern(engine.spark, source, fmt, signature))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
