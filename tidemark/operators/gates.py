"""Gates: predicates on a query, its question and the tables it may read.

Each gate takes what it needs and returns the problems it finds; none, and the
query passes. Gates look at tokens; G1 and G2 ask the engine and its analyzer.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from ..dialect.errors import QueryError
from ..dialect.tokens import Token, closing, split_on, tokenize
from ..engine import Engine
from . import plans
from .curation import PHRASES
from .harness import VALID, validate_query

ADDITIVE, NONADDITIVE, FLAG, CATEGORY, IDENTIFIER, EPOCH = "additive", "nonadditive", "flag", "category_numeric", "id", "epoch"
#: Placeholders that a question implies without naming them.
PLACEHOLDERS = frozenset(("none", "unknown", "n/a", "null", "other", "unclassified"))
#: Factors between units of time, and words for units: own lists.
UNIT_FACTORS = frozenset((60, 1000, 3600, 60000, 3600000, 86400, 86400000, 1000000))
UNIT_WORDS = frozenset(
    "epoch unix milli millis msec millisecond milliseconds micro micros microsecond microseconds s sec secs second seconds ms min mins minute minutes "
    "hr hrs hour hours day days".split()
)


@dataclass
class Table:
    """What gates know of a table: roles of its columns, rules and glossary."""

    name: str
    roles: dict[str, str] = field(default_factory=dict)
    rules: list[tuple[str, str]] = field(default_factory=list)  # (kind, column)
    glossary: list[dict] = field(default_factory=list)


@dataclass
class Call:
    """A function call in a query: name, arguments, and where it stands."""

    name: str
    args: list[list[Token]]
    distinct: bool


def calls(tokens: list[Token]) -> list[Call]:
    out = []
    for k, t in enumerate(tokens[:-1]):
        if t.kind == "word" and tokens[k + 1].text == "(":
            inner = tokens[k + 2 : closing(tokens, k + 1)]
            distinct = bool(inner) and inner[0].upper == "DISTINCT"
            out.append(Call(t.upper, split_on(inner[distinct:]), distinct))
    return out


def _bare(arg: list[Token]) -> str | None:
    """The column, if the argument is one."""
    return arg[-1].name if arg and arg[-1].is_name and (len(arg) == 1 or (len(arg) == 3 and arg[1].text == ".")) else None


def _clean(sql: str) -> str:
    return " ".join(t.name if t.kind == "quoted" else t.text for t in tokenize(sql))


def g0_style(sql: str) -> list[str]:
    """One statement without fence or semicolon; aliases quoted; grouping and ordering by place."""
    out = []
    if "```" in sql:
        return ["fence in the query"]
    if sql.strip().endswith(";"):
        out.append("trailing semicolon")
    try:
        tokens = tokenize(sql)
    except QueryError as e:
        return [*out, str(e)]
    opened: list[str] = []  # the words before the brackets that are open
    for k, t in enumerate(tokens):
        if t.text == "(" and t.kind == "op":
            opened.append(tokens[k - 1].upper if k else "")
        elif t.text == ")" and t.kind == "op":
            opened.pop()
        after = tokens[k + 1] if k + 1 < len(tokens) else Token("op", "")
        if t.upper == "AS" and after.kind == "word" and (not opened or opened[-1] not in ("CAST", "TRY_CAST")):
            out.append(f"alias {after.text!r} is not quoted")
        if t.upper in ("GROUP", "ORDER") and after.upper == "BY":
            in_window = bool(opened) and opened[-1] == "OVER"
            end, depth = k + 2, 0
            while end < len(tokens) and depth >= 0 and not (not depth and tokens[end].upper in ("HAVING", "ORDER", "LIMIT", "OFFSET", "UNION", "QUALIFY", "ROWS", "RANGE")):
                depth += (tokens[end].text == "(") - (tokens[end].text == ")")
                end += depth >= 0
            keys = split_on(tokens[k + 2 : end])
            plain = [[x for x in key if x.upper not in ("ASC", "DESC", "NULLS", "FIRST", "LAST")] for key in keys]
            sets = plain[0] and plain[0][0].upper in ("GROUPING", "ROLLUP", "CUBE")
            ordinal = all(len(p) == 1 and (p[0].kind == "number" or (t.upper == "ORDER" and p[0].name == "__time")) for p in plain)
            if not (ordinal or in_window or sets):
                out.append(f"{t.upper} BY must use ordinals")
    return sorted(set(out))


def g1_executes(engine: Engine, sql: str) -> list[str]:
    r = validate_query(engine, sql)
    return [] if r.status == VALID else [f"{r.status}: {r.error_message}"]


def g2_grounded(engine: Engine, sql: str, tables: set[str]) -> list[str]:
    """All tables read are among those given, and the analyzer resolves every column."""
    try:
        stray = plans.tables_read(engine, sql) - {t.lower() for t in tables}
    except QueryError as e:
        return [str(e)]
    return [f"reads tables that are not given: {sorted(stray)}"] if stray else []


def _stems(text: str) -> set[str]:
    """Words of a text, lower-cased, cut to five letters."""
    return {w[:5] for w in re.findall("[a-z0-9]+", text.lower())}


def _alludes(question: str, value: str) -> bool:
    """Whether the question has the value's leading word, in whatever inflection, or the value itself."""
    leading = next((w for w in re.findall("[a-z0-9]+", value.lower()) if len(w) > 2), None)
    spaced = lambda t: " ".join(re.findall("[a-z0-9]+", t.lower()))
    return leading is not None and leading[:5] in _stems(question) or bool(spaced(value)) and spaced(value) in spaced(question)


def compared_literals(tokens: list[Token]) -> list[str]:
    """Texts that a query compares with: after an operator, LIKE or THEN, in an IN list or an array, or in a test function."""
    out: list[str] = []
    opened: list[str] = []
    for before, t in zip([Token("op", ""), *tokens], tokens):
        if t.kind == "op" and t.text in "([":
            opened.append(before.upper)
        elif t.kind == "op" and t.text in ")]" and opened:
            opened.pop()
        elif t.kind == "string":
            listed = bool(opened) and opened[-1] in ("IN", "ARRAY", "MV_CONTAINS", "MV_OVERLAP", "STARTS_WITH", "REGEXP_LIKE")
            if listed or before.text in ("=", "<>", "!=", "<", ">", "<=", ">=") or before.upper in ("LIKE", "BETWEEN", "THEN", "ELSE"):
                out.append(t.name)
    return out


def g3_literals(question: str, sql: str, known: str | None = None, value_lists: list[list[str]] | None = None, allowed: set[str] = frozenset()) -> list[str]:
    """Values quoted in the question are used, and values compared with trace back to it or to ``known`` text.

    Of a value that only ``known`` has, no other of its list may be the one that
    the question alludes to.
    """
    tokens = tokenize(sql)
    core = lambda v: v.strip("%").strip().lower()
    everywhere = {core(t.name) for t in tokens if t.kind == "string"}
    out = [f"quoted {q!r} is missing from the query" for pair in re.findall(r"'([^']+)'|\"([^\"]+)\"", question) for q in pair if q and len(q) <= 60 and core(q) not in everywhere]
    for v in sorted({x.strip("%") or x for x in compared_literals(tokens)}):
        exempt = core(v) in PLACEHOLDERS or v.lower() in allowed or core(v) in question.lower()
        if exempt or _alludes(question, v) and (known is None or v.rstrip(". ") in known):
            continue
        if known is None or v.rstrip(". ") not in known:
            out.append(f"no source for the value {v!r}")
            continue
        rivals = [o for values in value_lists or [] if v in values for o in values if o != v and len(o) > 2 and _alludes(question, o)]
        out += [f"compares with {v!r} where the question means {rivals[0]!r}"] if rivals else []
    return out


def g5_roles(sql: str, tables: list[Table], total_asked: bool = False) -> list[str]:
    """Aggregates fit the roles of the columns they take as they are."""
    roles = {c: r for t in tables for c, r in t.roles.items()}
    out = []
    for c in calls(tokenize(sql)):
        column = _bare(c.args[0]) if len(c.args) == 1 else None
        role = roles.get(column or "")
        if c.name not in ("SUM", "AVG", "MIN", "MAX") or role is None:
            continue
        if role == EPOCH and c.name in ("SUM", "AVG"):
            out.append(f"{c.name}({column}) of a raw epoch")
        elif role in (IDENTIFIER, CATEGORY):
            out.append(f"{c.name}({column}) of {'an id' if role == IDENTIFIER else 'a category'}")
        elif role == NONADDITIVE and c.name == "SUM" and not total_asked:
            out.append(f"SUM({column}) of a measure that doesn't add up")
    return out


@dataclass
class Shown:
    """What a query shows: names, texts, numbers, and keywords with operators."""

    names: set[str]
    texts: set[str]
    numbers: set[float]
    words: set[str]

    @staticmethod
    def of(tokens: list[Token]) -> Shown:
        kinds = lambda *k: [t for t in tokens if t.kind in k]
        return Shown({t.name for t in kinds("word", "quoted")}, {t.name for t in kinds("string")}, {float(t.text) for t in kinds("number")}, {t.upper for t in kinds("word", "op")})

    def window(self, days: float) -> bool:
        return float(days) in self.numbers or bool({f"P{days}D", f"{days}"} & self.texts)


def _all_values(entry: dict, q: Shown) -> bool:
    return set(map(str, entry.get("values") or [])) <= q.texts and {float(n) for n in entry.get("numbers") or []} <= q.numbers


#: Evidence that each shape of a glossary entry asks for: (what, test of entry and query). Other shapes ask for their values.
_VALUES = ("its values", _all_values)
EVIDENCE = {
    "like_prefix": [("a match of its prefix", lambda e, q: any(t.startswith(str(e["values"][0])) for t in q.texts) and bool(q.words & {"LIKE", "STARTS_WITH", "LEFT", "SUBSTR", "SUBSTRING"}))],
    "time_active": [("its window", lambda e, q: q.window(e["window_days"]))],
    "not_in": [_VALUES, ("a negation", lambda e, q: bool(q.words & {"NOT", "<>", "!="}))],
    "derived": [
        _VALUES,
        ("a division", lambda e, q: e.get("derived_kind") != "ratio" or "/" in q.words),
        ("a conversion of units", lambda e, q: e.get("derived_kind") != "time" or e.get("divisor", 1) == 1 or float(e["divisor"]) in q.numbers),
    ],
}


def applies_term(entry: dict, sql: str) -> str | None:
    """What a query lacks of the evidence for a glossary entry; None if nothing."""
    q = Shown.of(tokenize(sql))
    unused = set(entry.get("columns") or [entry["column"]]) - q.names
    lacking = [f"column {c}" for c in sorted(unused)] + [what for what, shown in EVIDENCE.get(entry.get("shape"), [_VALUES]) if not shown(entry, q)]
    return "lacks " + ", ".join(lacking) if lacking else None


@dataclass
class Use:
    """How a query uses columns: in aggregates, in distinct counts, with tests for null or for zero."""

    names: set[str]
    aggregated: set[str]
    counted: set[str | None]
    estimated: set[str | None]
    not_null: set[str]
    zero: set[str]

    @staticmethod
    def of(tokens: list[Token]) -> Use:
        found = calls(tokens)
        followed = [(t.name, [x.upper or x.text for x in tokens[k + 1 : k + 4]]) for k, t in enumerate(tokens)]
        return Use(
            {t.name for t in tokens if t.is_name},
            {t.name for c in found if c.name in ("SUM", "AVG", "MIN", "MAX", "APPROX_QUANTILE_DS") for a in c.args for t in a if t.is_name},
            {_bare(c.args[0]) for c in found if c.name == "COUNT" and c.distinct},
            {_bare(c.args[0]) for c in found if c.name == "APPROX_COUNT_DISTINCT"},
            {name for name, after in followed if after == ["IS", "NOT", "NULL"]},
            {name for name, after in followed if after[:2] in (["=", "0"], ["<>", "1"], ["!=", "1"])},
        )


#: Kinds of rules: whether a use of a column breaks one, and what the rule says.
RULES = {
    "nullable_metric": (lambda c, u: c in u.aggregated and c not in u.not_null, "aggregates of {} leave nulls out by IS NOT NULL"),
    "duration_end": (lambda c, u: c in u.names and c not in u.not_null, "uses of {} leave open ends out by IS NOT NULL"),
    "unique_by": (lambda c, u: c in u.counted, "{} is unique: count rows, not DISTINCT values"),
    "exact_distinct": (lambda c, u: c in u.estimated, "distinct values of {} are counted exactly"),
    "exclude_flag": (lambda c, u: c not in u.zero, "rows are those with {} = 0"),
}


def _asks_for(question: str, term: str) -> bool:
    """Whether the question has the term's words in a row, the last also as a plural or possessive."""
    asked, wanted = (re.findall(r"[\w]+(?:'s)?", t.lower()) for t in (question, term))
    endings = {wanted[-1] + e for e in ("", "s", "es", "'s", "s's", "es's")} if wanted else set()
    return any(asked[k : k + len(wanted) - 1] == wanted[:-1] and asked[k + len(wanted) - 1] in endings for k in range(len(asked) - len(wanted) + 1)) if wanted else False


def g6_instructions(question: str, sql: str, tables: list[Table]) -> list[str]:
    """Rules of the tables that the query reads, and glossary terms that the question uses, are obeyed."""
    use = Use.of(tokenize(sql))
    read = [t for t in tables if t.name.lower() in {n.lower() for n in use.names}]
    broken = [RULES[kind][1].format(column) for t in read for kind, column in t.rules if kind in RULES and RULES[kind][0](column, use)]
    terms = [(e["term"], applies_term(e, sql)) for t in read for e in t.glossary if _asks_for(question, e["term"])]
    return broken + [f"{term!r}: {why}" for term, why in terms if why]


def g7_style_truth(question: str, answer_columns: list[str], style: str) -> list[str]:
    """Questions in business wording name no column; those that are to name one do."""
    shown = {w for w in re.findall(r"\w+", question.lower())} & {c.lower() for c in answer_columns}
    wanted = {"business": False, "vocab_gap": False, "exact_column": True}.get(style)
    if wanted is None or wanted == bool(shown):
        return []
    return [f"wording {style!r} needs a column of the answer"] if wanted else [f"wording {style!r} gives away {', '.join(sorted(shown))}"]


_PHRASES = [(re.compile(pattern), need) for pattern, need in PHRASES]


def g8_phrases(question: str, sql: str) -> list[str]:
    """Time phrases of the question have their window in the query."""
    asked = [(m[0], need) for pattern, need in _PHRASES if (m := pattern.search(question))]
    flat = " ".join(t.text for t in tokenize(sql)).upper() if asked else ""
    return [f"{phrase!r} asks for {' and '.join(need)}" for phrase, need in asked if any(part not in flat for part in need)]


def epoch_columns(tables: list[Table]) -> set[str]:
    return {c for t in tables for c, r in t.roles.items() if r == EPOCH}


def epoch_arithmetic(engine: Engine, sql: str, tables: list[Table]) -> set[str]:
    """The feature ``epoch_arith``: epoch columns that the query converts, scales, subtracts or compares as moments."""
    return plans.unit_dependent(engine, sql, epoch_columns(tables), UNIT_FACTORS)


def _unit_dependent_names(tokens: list[Token]) -> set[str]:
    """What :func:`epoch_arithmetic` finds, by tokens alone, for where there is no analyzer: operands are columns, calls and brackets."""
    used = {x.name for c in calls(tokens) if c.name == "MILLIS_TO_TIMESTAMP" for a in c.args for x in a if x.is_name}
    for k, t in enumerate(tokens):
        if t.kind != "op" or t.text not in ("*", "/", "-", "<", ">", "=", "<=", ">="):
            continue
        sides = _before(tokens, k), _after(tokens, k)
        names = [{x.name for x in side if x.is_name} for side in sides]
        numbers = {float(x.text) for side in sides for x in side if x.kind == "number" and len(side) == 1}
        if (t.text in "*/" and numbers & UNIT_FACTORS) or (t.text == "-" and all(names)) or (t.text in ("<", ">", "=", "<=", ">=") and any(n >= 1e8 for n in numbers)):
            used |= names[0] | names[1]
    return used


def _before(tokens: list[Token], k: int) -> list[Token]:
    """The operand that ends before ``k``, without what qualifies a column."""
    if k and tokens[k - 1].text == ")":
        opened = next(j for j in range(k - 1, -1, -1) if tokens[j].text == "(" and tokens[j].kind == "op" and closing(tokens, j) == k - 1)
        return tokens[opened:k]
    return tokens[max(0, k - 1) : k]


def _after(tokens: list[Token], k: int) -> list[Token]:
    """The operand that begins after ``k``."""
    at = k + 1
    if at + 1 < len(tokens) and tokens[at].is_name and tokens[at + 1].text == ".":
        at += 2
    opened = at + (at + 1 < len(tokens) and tokens[at].kind == "word" and tokens[at + 1].text == "(")
    if opened < len(tokens) and tokens[opened].text == "(":
        return tokens[opened : closing(tokens, opened) + 1]
    return tokens[at : at + 1]


def g10_epoch_unit(sql: str, prompt: str, tables: list[Table], engine: Engine | None = None) -> list[str]:
    """Epoch columns whose unit the query relies on have it stated: in the name, the text after it, or sample rows.

    With an engine the analysed plan tells which columns these are, else the tokens.
    """
    used = epoch_arithmetic(engine, sql, tables) if engine else _unit_dependent_names(tokenize(sql)) & epoch_columns(tables)
    parts = lambda text: [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+", text)]

    def stated(column: str) -> bool:
        named = len(parts(column)) > 1 and parts(column)[-1] in UNIT_WORDS
        return named or "Sample rows:" in prompt or any(UNIT_WORDS & set(parts(after[:170])) for after in prompt.split(column)[1:])

    return [f"the unit of {c!r} is not stated" for c in sorted(used) if not stated(c)]
