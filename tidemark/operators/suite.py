"""Suites of queries with what is expected of them: the runner, scope and decoy gates,
scores of predictions, revalidation on seeds, and counts that must be zero."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dialect.tokens import Token, closing, render, split_on, tokenize
from ..engine import Engine
from . import gates
from .canonical import results_agree
from .curation import features, unwrap
from .harness import INVALID, VALID, QueryResult, validate_query

#: Fixed value: what a prediction that declines to answer begins with.
DECLINED = "-- CANNOT_ANSWER"
#: Seed data whose clock is older than this many days leave windows that end now empty.
STALE_DAYS = 14


def swap_tables(sql: str, names: dict[str, str]) -> str:
    """The query on other tables: whole identifiers only, never texts."""
    return render([Token("word", names[t.name]) if t.is_name and names.get(t.name, t.name) != t.name else t for t in tokenize(sql)])


def _without_rows(engine: Engine, record: dict, result: QueryResult, seconds: float) -> Iterator[str]:
    if record.get("expect_rows") and not result.row_count:
        yield "the result is empty"


def _without_texts(engine: Engine, record: dict, result: QueryResult, seconds: float) -> Iterator[str]:
    yield from (f"{part!r} does not occur" for part in record.get("must_contain") or [] if part not in record["sql"])


def _harmless_trap(engine: Engine, record: dict, result: QueryResult, seconds: float) -> Iterator[str]:
    trap = record.get("trap")
    if trap:
        naive = validate_query(engine, trap["naive_sql"], seconds)
        caught = naive.status == INVALID if trap["expect"] == INVALID else naive.status == VALID and not results_agree(engine.sql(record["sql"]), engine.sql(trap["naive_sql"]))
        if not caught:
            yield f"the naive query is {naive.status}" + (" with the same rows" if naive.status == VALID != trap["expect"] else "")


#: What may be expected of a query that runs, and who finds what is not so.
EXPECTATIONS = {"ROWS": _without_rows, "LINT": _without_texts, "TRAP": _harmless_trap}


def run_expectations(engine: Engine, record: dict, timeout_seconds: float = 45) -> list[str]:
    """What a record's query doesn't fulfil: it runs (EXEC), has rows where it should (ROWS),
    holds the texts named (LINT), and its naive twin is rejected or gives other rows (TRAP)."""
    result = validate_query(engine, record["sql"], timeout_seconds)
    if result.status != VALID:
        return [f"EXEC {result.status}: {result.error_message}"]
    return [f"{label} {problem}" for label, find in EXPECTATIONS.items() for problem in find(engine, record, result, timeout_seconds)]


def g4_agreement(engine: Engine, sql: str, other: str, seeds: list[dict[str, str]], max_rows: int | None = None, least: int = 2, timeout_seconds: float = 45) -> list[str]:
    """Two independent queries for one question, on each seed: a map of table names to that seed's tables.

    They run, give the same rows within the tolerance, and have rows on ``least``
    seeds, as empty results agree by chance. Results are compared where they lie,
    whatever their size; ``max_rows``, if given, rejects larger ones.
    """
    problems, filled = [], 0
    for k, names in enumerate(seeds):
        pair = [swap_tables(q, names) for q in (sql, other)]
        failed = next((r for q in pair if (r := validate_query(engine, q, timeout_seconds, max_rows=1)).status != VALID), None)
        if failed is not None:
            problems.append(f"G4 seed {k}: {failed.status}: {failed.error_message}")
            continue
        rows = [engine.sql(q) for q in pair]
        n = rows[0].limit((max_rows or 0) + 1).count()
        filled += n > 0
        if max_rows is not None and n > max_rows:
            problems.append(f"G4 seed {k}: over {max_rows} rows")
        elif not results_agree(*rows):
            problems.append(f"G4 seed {k}: the results differ")
    if not problems and filled < min(least, len(seeds)):
        problems.append(f"G4 rows on {filled} of {len(seeds)} seeds only")
    return problems


# the time window asked for ---------------------------------------------------------
class Moment(NamedTuple):
    """A point in time as a query writes it, and where its tokens end."""

    kind: str  # now, stamp, back (now less an interval), floored, shifted (now), before (the start of a period, shifted back by it)
    period: str
    end: int


def _moment(tokens: list[Token], k: int) -> Moment | None:
    """The point in time that begins at ``k``, as far as it hangs on the clock or is written out."""
    t, after = tokens[k], tokens[k + 1 : k + 3]
    if t.upper == "TIMESTAMP" and after and after[0].kind == "string":
        return Moment("stamp", "", k + 2)
    if t.upper == "CURRENT_TIMESTAMP":
        back = [x.upper for x in after] == ["-", "INTERVAL"]
        return Moment("back" if back else "now", "", k + 3 if back else k + 1)
    if t.upper not in ("TIME_FLOOR", "TIME_SHIFT") or not after or after[0].text != "(":
        return None
    end = closing(tokens, k + 1)
    args = split_on(tokens[k + 2 : end])
    inner = _moment(args[0], 0) if args[0] else None
    if inner is None or inner.end != len(args[0]) or len(args) < 2:
        return None
    period = args[1][0].name.upper()
    if t.upper == "TIME_FLOOR":
        return Moment("floored", period, end + 1) if inner.kind == "now" else None
    if inner.kind == "floored":
        return Moment("before", period, end + 1) if inner.period == period and render(args[2]) == "- 1" else None
    return Moment("shifted", period, end + 1) if inner.kind == "now" else None


def windows(sql: str) -> set[str]:
    """Kinds of time windows that a query has, by the points in time in it and where ``__time`` is compared."""
    tokens, found = tokenize(sql), set()
    names = [t.name.lower() for t in tokens]
    for k, t in enumerate(tokens):
        since = k > 1 and names[k - 2] == "__time" and tokens[k - 1].text in (">", ">=")
        if names[k] == "__time" and k + 1 < len(tokens) and (tokens[k + 1].text in ("<", ">", "<=", ">=") or tokens[k + 1].upper == "BETWEEN"):
            found.add("bounded")
        if (m := _moment(tokens, k)) is None:
            continue
        longer = m.period[:1] == "P" and m.period[-1:] in tuple("WMY")
        found |= {"now"} if m.kind != "stamp" else {"explicit_range"}
        found |= {"rolling", "definition"} if m.kind == "back" else {"definition"} if m.kind == "shifted" else set()
        if m.kind == "floored":
            found |= {"day"} if m.period == "P1D" else {"this_period"} if longer and since else set()
        if m.kind == "before" and longer:
            found.add("last_period")
    return found


def spec_scope(scope: str | None, sql: str) -> list[str]:
    """Whether the query's time window is of the kind asked for; ``none`` asks for no window."""
    found = windows(sql)
    held = not scope or (not found & {"bounded", "now"} if scope == "none" else scope in found)
    return [] if held else [f"SPEC the query has no window of kind {scope!r}"]


def spec_features(assigned: set[str], found: set[str]) -> list[str]:
    """Features that were assigned and are missing; see :func:`tidemark.operators.curation.features`."""
    return [f"SPEC feature {f!r} is missing" for f in sorted(assigned - found)]


def spec_term(term: str, shown: list[str], question: str) -> list[str]:
    """The question uses the assigned glossary term, and none of the others shown."""
    missing = [] if gates._asks_for(question, term) else [f"SPEC the question lacks the term {term!r}"]
    return missing + [f"SPEC the question uses {t!r} beside {term!r}" for t in shown if t != term and gates._asks_for(question, t)]


def decoy(word: str, question: str, sql: str, glossary: list[dict], column: str | None = None, value: str | None = None) -> list[str]:
    """A word that only looks like a glossary term: the question has it, uses no term, and the query applies none.

    With ``column`` (and ``value``) the word means that column, which the query
    filters; else it is plain English and stays out of the query.
    """
    tokens = tokenize(sql)
    shown, terms = gates.Shown.of(tokens), {e["term"]: e for e in glossary}
    asked = [t for t in terms if gates._asks_for(question, t)]
    applied = [t for t, e in terms.items() if t not in asked and not gates.applies_term(e, sql)]
    meant = column is None or (column in shown.names and (not value or value in shown.texts))
    spelled = column is None and any(word in t.text.lower() for t in tokens)
    wrong = {
        f"SPEC the question lacks the decoy {word!r}": not re.search(rf"\b{re.escape(word)}\b", question, re.I),
        **{f"SPEC the question uses the term {t!r}": True for t in asked},
        **{f"DECOY the query applies {t!r}, which nobody asked for": True for t in applied},
        f"SPEC the query does not filter {column!r}, which the decoy means": not meant,
        f"SPEC the plain word {word!r} occurs in the query": spelled,
    }
    return [problem for problem, there in wrong.items() if there]


def through_gates(engine: Engine, record: dict, tables: list[gates.Table], seeds: list[dict[str, str]] | None = None, timeout_seconds: float = 45) -> dict[str, list[str]]:
    """A record through all gates: name of each gate that finds problems -> the problems.

    ``record`` holds question and sql, and what of these its gates need: prompt,
    style, answer_columns, scope, features, term and shown (glossary terms), decoy
    (arguments of :func:`decoy`), max_words, other_sql (the independent query).
    Gates on texts come first; the query runs, on all seeds, only if it passes them.
    """
    sql, question, names = record["sql"], record["question"], {t.name for t in tables}
    get = record.get
    found = {
        "G0": gates.g0_style(sql),
        "G2": gates.g2_grounded(engine, sql, names),
        "G3": gates.g3_literals(question, sql, get("prompt")),
        "G5": gates.g5_roles(sql, tables, bool(re.search("total|sum", question.lower()))),
        "G6": gates.g6_instructions(question, sql, tables),
        "G7": gates.g7_style_truth(question, get("answer_columns") or [], get("style") or ""),
        "G8": gates.g8_phrases(question, sql),
        "SPEC": spec_scope(get("scope"), sql) + (spec_term(get("term"), get("shown") or [], question) if get("term") else []),
        "DECOY": decoy(question=question, sql=sql, glossary=[e for t in tables for e in t.glossary], **get("decoy")) if get("decoy") else [],
        "WORDS": [f"over {get('max_words')} words"] if get("max_words") and len(question.split()) > get("max_words") else [],
    }
    if not found["G2"]:
        found["G10"] = gates.g10_epoch_unit(sql, get("prompt") or "", tables, engine)
        if get("features"):
            used = set(engine.spark.createDataFrame([(sql,)], "sql string").select(features(F.col("sql"))).first()[0])
            used |= {"epoch_arith"} if gates.epoch_arithmetic(engine, sql, tables) else set()
            found["SPEC"] += spec_features(set(get("features")), used)
    if not any(found.values()):
        found["G1"] = gates.g1_executes(engine, sql)
        if get("other_sql"):
            found["G4"] = g4_agreement(engine, sql, get("other_sql"), seeds or [{}], least=min(2, len(seeds or [{}])), timeout_seconds=timeout_seconds)
    return {gate: problems for gate, problems in found.items() if problems}


# predictions, seeds --------------------------------------------------------------------
class OnSeeds:
    """One query on engines that have the same tables with other seeds: how it ran on each, and where it has rows."""

    def __init__(self, engines: list[Engine], sql: str):
        self.results = [validate_query(e, sql, max_rows=1) for e in engines]
        self.failed = [(k, r) for k, r in enumerate(self.results) if r.status != VALID]
        self.filled = sum(1 for r in self.results if r.status == VALID and r.row_count)

    def fills(self, least: int) -> bool:
        """Whether it has rows on ``least`` seeds, or on all if there are fewer."""
        return self.filled >= min(least, len(self.results))


def judge_predictions(engines: list[Engine], gold: list[dict], predictions: dict[str, str], least: int = 2) -> DataFrame:
    """One row per predicted record, for :func:`tidemark.operators.curation.score_predictions`.

    ``gold`` holds id, sql, tables and unanswerable; engines have the same tables
    with other seeds. A row whose gold query has rows on fewer than ``least``
    seeds can't be scored by result. ``instructed`` is null for records that
    showed no rules; such rules are the tables of ``shown``, with the question.
    """
    spark = engines[0].spark
    known = {g["id"]: g for g in gold}
    texts = spark.createDataFrame([(k, v) for k, v in predictions.items() if k in known] or [(None, None)], "id string, text string").where("id IS NOT NULL")
    rows = []
    for r in texts.select("id", F.coalesce(unwrap(F.col("text")), F.lit("")).alias("sql")).collect():
        record, sql = known[r["id"]], r["sql"]
        row = {"id": r["id"], "unanswerable": bool(record.get("unanswerable")), "declined": sql.lstrip().startswith(DECLINED)}
        if not row["declined"] and not row["unanswerable"]:
            tried, wanted = OnSeeds(engines, sql), OnSeeds(engines, record["sql"])
            row |= {"valid": not tried.failed, "unscorable": not wanted.fills(least), "grounded": not gates.g2_grounded(engines[0], sql, set(record["tables"]))}
            if not (tried.failed or wanted.failed or row["unscorable"]):
                row["result_match"] = all(results_agree(e.sql(record["sql"]), e.sql(sql)) for e in engines)
            if record.get("shown"):
                row["instructed"] = not gates.g6_instructions(record.get("question", ""), sql, record["shown"])
        rows.append(row)
    schema = "id string, valid boolean, grounded boolean, result_match boolean, declined boolean, unanswerable boolean, unscorable boolean, instructed boolean"
    flags = [c.split()[0] for c in schema.split(", ")]
    judged_ = spark.createDataFrame([tuple(row.get(c) for c in flags) for row in rows], schema)
    return judged_.select("id", *[F.coalesce(c, F.lit(False)).alias(c) for c in flags[1:-1]], "instructed")


def revalidate(engines: list[Engine], records: Iterator[dict] | list[dict], require_rows: bool = True, least: int = 2) -> Iterator[tuple[str, str]]:
    """``(id, problem)`` of each record whose gold query no longer runs on all seeds, or has rows on too few."""
    for record in records:
        if record.get("unanswerable"):
            continue
        now = OnSeeds(engines, record["sql"])
        if now.failed:
            yield record["id"], "; ".join(f"seed {k}: {r.status}, {r.error_message}" for k, r in now.failed)
        elif require_rows and not now.fills(least):
            yield record["id"], f"rows on {now.filled} of {len(engines)} seeds"


def anchor_age(anchor: Column, now: Column) -> Column:
    """Whole days from the seed data's clock to now."""
    return F.floor((F.unix_seconds(now) - F.unix_seconds(anchor)) / 86400)


def is_stale(anchor: Column, now: Column, limit: int = STALE_DAYS) -> Column:
    return anchor_age(anchor, now) > limit


# counts that must be zero -----------------------------------------------------------
#: Counter -> problems that its gate finds in a record of ``question, sql, prompt, style, answer_columns``.
COUNTERS: dict[str, Callable[[dict, list[gates.Table]], list[str]]] = {
    "output_style_violation": lambda r, t: gates.g0_style(r["sql"]),
    "literal_mismatch": lambda r, t: gates.g3_literals(r["question"], r["sql"], r["prompt"]),
    "role_violation": lambda r, t: gates.g5_roles(r["sql"], t, bool(re.search("total|sum", r["question"].lower()))),
    "instruction_violation": lambda r, t: gates.g6_instructions(r["question"], r["sql"], t),
    "style_truth_violation": lambda r, t: gates.g7_style_truth(r["question"], list(r["answer_columns"]), r["style"]),
    "phrase_violation": lambda r, t: gates.g8_phrases(r["question"], r["sql"]),
    "hidden_epoch_unit": lambda r, t: gates.g10_epoch_unit(r["sql"], r["prompt"], t),
}
_RECORD = ("question", "sql", "prompt", "style", "answer_columns")


def judged(records: DataFrame, tables: list[gates.Table], counters: Sequence[str] = tuple(COUNTERS)) -> DataFrame:
    """Records with a boolean per counter: whether its gate finds a problem.

    Rows that are unanswerable or lack a question or a query break nothing. The
    gates look at texts alone, so rows are judged where they are, in batches, and
    by the gates of ``counters`` only.
    """
    schema = ", ".join(f"`{n}` {t}" for n, t in records.dtypes) + "".join(f", {c} boolean" for c in counters)

    def problems(skip, question, sql, prompt, style, answer_columns):
        if skip or not question or not sql:
            return [False] * len(counters)
        record = dict(zip(_RECORD, (question, sql, prompt or "", style, answer_columns or [])))
        return [bool(COUNTERS[c](record, tables)) for c in counters]

    def batches(parts):
        for b in parts:
            found = [problems(*row) for row in zip(*[b.column(c).to_pylist() for c in ("unanswerable", *_RECORD)])]
            flags = [pa.array([row[k] for row in found], pa.bool_()) for k in range(len(counters))]
            yield pa.RecordBatch.from_arrays([*b.columns, *flags], [*b.schema.names, *counters])

    return records.mapInArrow(batches, schema)


def must_be_zero(records: DataFrame, tables: list[gates.Table], split: str = "split") -> DataFrame:
    """Per split, how many records break each gate."""
    return judged(records, tables).groupBy(split).agg(*[F.count_if(c).alias(c) for c in COUNTERS])


def ungrounded(engine: Engine, records: DataFrame, split: str = "split") -> dict[str, int]:
    """Per split, how many queries name tables not given or columns not there.

    The catalog is the driver's, so the texts pass through it one by one and are
    analyzed, not run; nothing but the counts is held.
    """
    counts: dict[str, int] = {}
    for r in records.where("NOT coalesce(unanswerable, false)").select(split, "sql", "tables").toLocalIterator():
        counts[r[0]] = counts.get(r[0], 0) + bool(gates.g2_grounded(engine, r["sql"] or "", set(r["tables"] or [])))
    return counts
