"""Secret scans: fixed rules, and character Markov models for what they miss.

Rules give spans of three kinds; the model adds spans of the kind ``random``.
Runs of token characters are scored by the log-likelihood ratio of two character
bigram models, one of random strings and one of ordinary identifiers, trained
from labelled samples. Only DataFrame functions.

Spans are in code points, end exclusive. Positions come from the lengths of the
matches and of the text between them.
"""

from __future__ import annotations

import importlib
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused

# The rules' patterns, letters of the keywords in either case.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Shortest value of an assignment.
VALUE = 12
#: Runs that the model judges: their characters, in the order of their codes, and least length.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{12,}"
#: Sequences that people type.
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "9876543210", "zyxwvutsrqponmlkjihgfedcba", "qwertyuiopasdfghjklzxcvbnm", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/")
#: Modules of the standard library whose names are samples of identifiers.
MODULES = tuple("argparse asyncio ast calendar collections configparser csv ctypes datetime decimal email functools http.client http.server inspect io json locale logging logging.handlers multiprocessing os pathlib "
                "pickle platform queue random shutil smtplib socket socketserver sqlite3 ssl statistics subprocess tarfile tempfile threading tokenize typing unittest urllib.parse urllib.request uuid warnings xml.dom.minidom xml.sax zipfile".split())
#: Least different characters of a run that the model judges: fewer make rules and padding.
DIFFERENT = 5
#: Identifiers of a fixed form, which are random and no secrets.
UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
KINDS = ("assign", "access", "hex", "random")
#: What a run's log-likelihood ratio must come to: for each of its characters, and in all. The
#: latter outweighs odds of one to e^15 that an ordinary run of token characters is a secret.
NATS_PER_CHAR, NATS = 0.75, 15.0
#: Matches of a text that are worked off at a time.
CHUNK = 256
SIZE = len(ALPHABET) + 1
#: Distinct tokens from which a bigram is learnt only from other tokens than the one with most of it.
ENOUGH = 100
#: How often the joined forms of a run and itself hold a bigram of it.
WITH_JOINED = 10


def located(df: DataFrame, name: str, text: str, pattern: str, ok: str, extra: str = "") -> DataFrame:
    """Adds ``name``: array of (start, end[, extra]) of the matches for which ``ok`` holds.

    ``ok`` and ``extra`` are SQL over the match ``x``. Running positions are
    summed by chunks of matches, so the work grows with their number.
    """
    m, g = f"_{name}_m", f"_{name}_g"
    df = df.withColumn(m, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(text, pattern, -1)))
    # both arrays are arguments: inside the lambda they would be made anew for each match
    df = df.withColumn(m, F.expr(f"zip_with({m}, slice({g}, 1, size({m})), (x, gap) -> named_struct('gap', length(gap), 'len', length(x), 'ok', {ok}{', ' + repr('v') + ', ' + extra if extra else ''}))"))
    value = ", 'v', x.v" if extra else ""
    kind = "struct<start:int,end:int" + (",v:string" if extra else "") + ">"
    step = f"sequence(0, (size({m}) - 1) div {CHUNK})"
    piece = f"slice({m}, c * {CHUNK} + 1, {CHUNK})"
    df = df.withColumn(g, F.expr(f"""CASE WHEN size({m}) > 0 THEN aggregate({step}, array(0),
        (acc, c) -> concat(acc, array(element_at(acc, -1) + aggregate({piece}, 0, (s, x) -> s + x.gap + x.len)))) END"""))
    # two uses of a column keep Spark from moving its expression into the lambda
    df = df.withColumn(name, F.expr(f"""CASE WHEN size({m}) > 0 AND size({g}) > 0 THEN flatten(transform({step}, c -> aggregate({piece},
        named_struct('at', {g}[c], 'out', CAST(array() AS array<{kind}>)),
        (acc, x) -> named_struct('at', acc.at + x.gap + x.len, 'out', CASE WHEN x.ok
            THEN concat(acc.out, array(named_struct('start', acc.at + x.gap, 'end', acc.at + x.gap + x.len{value}))) ELSE acc.out END),
        acc -> acc.out))) ELSE CAST(array() AS array<{kind}>) END"""))
    return df.drop(m, g)


def identifiers() -> list[str]:
    """Ordinary identifiers: names in :data:`MODULES` and their classes, and pairs and triples of the words in them, joined in five ways."""
    names: set[str] = set()
    for m in map(importlib.import_module, MODULES):
        names |= {n for x in (m, *[v for v in vars(m).values() if isinstance(v, type)]) for n in dir(x)}
    words = sorted({w.lower() for n in names for w in re.findall("[A-Z]?[a-z]{2,}|[A-Z]{3,}", n)})
    out = {n for n in names if len(n) >= 6}
    for k in range(2 * len(words)):
        # steps prime to the number of words pair each with others
        some = [words[(k * step + step) % len(words)] for step in ((7, 11) if k % 2 else (13, 17, 19))]
        out |= {"".join(some), "".join(w.title() for w in some), "_".join(some), "_".join(some).upper(), "/" + "/".join(some)}
    return sorted(out)


def labelled_samples(rows: DataFrame, n_texts: int, sample_texts: int = 1000) -> DataFrame:
    """``(origin, token, random, weight, met)`` for training, from about ``sample_texts`` of the ``n_texts`` distinct texts.

    Random: what the rules find in them, and digests of numbers in base 64 and
    base 16. Ordinary: runs of token characters that no rule touches, as they
    are, in capitals and joined as identifiers, paths and compounds are, of which the run, by its hash, is the ``origin``; times and
    numbers of all lengths, alphabets, and :func:`identifiers`. Tokens
    are distinct; each weighs as much as its occurrences in the one text that
    has most of them, so copies and near copies of a text add nothing. ``met``
    tells those of the texts from those made here.
    """
    spark = rows.sparkSession
    some = rows.select("text").where(F.pmod(F.xxhash64("text"), F.lit(max(1, n_texts))) < sample_texts).dropDuplicates(["text"])
    some = some.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("h"))
    found = F.concat(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1)), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    secrets = some.select("h", F.explode(found).alias("token"), F.lit(True).alias("random")).where(F.length("token") >= VALUE)
    words = some.select("h", F.explode(F.regexp_extract_all(plain, F.lit(r"[A-Za-z0-9+/_=-]{6,}"), F.lit(0))).alias("token"), F.lit(False).alias("random"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(0, 3000, 1, 1).select(F.lit(None).cast("long").alias("h"), F.when(F.col("id") % 3 < 2, F.base64(F.unhex(digest))).otherwise(digest).alias("token"), F.lit(True).alias("random"))
    day = F.timestamp_seconds(F.col("id") * 86_000)
    figures = F.array(F.date_format(day, "yyyy-MM-dd-HH-mm-ss"), F.date_format(day, "yyyyMMddHHmmss"), (F.col("id") * 987_654_321_987).cast("string"))
    figures = spark.range(1, 20_001, 400, 1).select(F.explode(figures).alias("token"))
    # decimal digits of digests, each with a length of its own
    numbers = spark.range(0, 3000, 1, 1).select(F.expr("substr(regexp_replace(concat(sha2(concat('n', id), 512), sha2(concat('m', id), 512)), '[a-f]', ''), 1, 12 + id % 37)").alias("token"))
    alphabets = spark.range(0, 120, 1, 1).select("id", F.explode(F.array(*map(F.lit, ALPHABETS))).alias("c")).select(F.expr("substr(repeat(c, 8), CAST(1 + id AS INT), CAST(14 + id % 40 AS INT))").alias("token"))
    # as one literal, some 400 KB whatever the table
    named = spark.range(0, 1, 1, 1).select(F.explode(F.split(F.lit(" ".join(identifiers())), " ")).alias("token"))
    figures = figures.union(numbers).union(alphabets).union(named)
    figures = figures.select(F.lit(None).cast("long").alias("h"), "token", F.lit(False).alias("random"))
    tokens = secrets.union(words).union(made).union(figures)
    tokens = tokens.groupBy("h", "token", "random").count().groupBy("token", "random").agg(F.max("count").alias("weight"), F.max(F.col("h").isNotNull()).alias("met"))
    joined = F.array("token", F.upper("token"), F.concat("token", F.initcap("token")), F.concat(F.lower("token"), F.lower("token")), *[F.concat("token", F.lit(c), "token") for c in "/-_"])
    forms = F.when(F.col("met") & ~F.col("random"), joined).otherwise(F.array("token"))
    return tokens.select(F.xxhash64("token").alias("origin"), F.explode(forms).alias("token"), "random", "weight", "met")


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios, random to ordinary, of each character after each.

    ``samples`` is as of :func:`labelled_samples`; bigram models, each bigram
    less what the one origin's tokens give that have most of it, so that a
    secret among the ordinary tokens counts nothing however often it comes (of
    fewer than ENOUGH tokens, less one occurrence with its joined forms only), smoothed toward single characters, and these by a half, as a flat list by
    ``code(previous) * SIZE + code(next)``, code 0 standing for the start and
    for characters outside of the alphabet. At most SIZE * SIZE * 2 counts come
    to the driver.
    """
    code = lambda c: F.instr(F.lit(ALPHABET), c)
    chars = F.split("token", "")
    steps = F.explode(F.zip_with(F.concat(F.array(F.lit("")), chars), chars, lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    pairs = samples.where("token IS NOT NULL AND token != ''").select("random", "origin", "weight", "met", steps.alias("p")).where("p.b IS NOT NULL")
    pairs = pairs.select("random", "origin", "weight", ((F.col("p.a") == "") & (F.col("met") | F.col("random"))).cast("int").alias("first"), F.when(F.col("p.a") == "", 0).otherwise(code(F.col("p.a"))).alias("a"), code(F.col("p.b")).alias("b"))
    pairs = pairs.groupBy("random", "origin", "a", "b").agg(F.sum("weight").alias("n"), F.sum("first").alias("first"))
    counts = pairs.groupBy("random", "a", "b").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("first").alias("first")).collect()
    logs = {}
    for kind in (True, False):
        n = [[0.0] * SIZE for _ in range(SIZE)]
        enough = sum(r["first"] for r in counts if r["random"] == kind) >= ENOUGH
        for r in counts:
            if r["random"] == kind:
                n[r["a"]][r["b"]] += max(0, r["n"] - (r["most"] if enough else 1 if kind else WITH_JOINED))
        alone = [sum(row[b] for row in n) + 0.5 for b in range(SIZE)]
        share = [x / sum(alone) for x in alone]
        logs[kind] = [math.log((row[b] + 5 * share[b]) / (sum(row) + 5)) for row in n for b in range(SIZE)]
    return [x - y for x, y in zip(logs[True], logs[False])]


def ratio_sql(token: str, table: str) -> str:
    """SQL for the log-likelihood ratio of a token, as by ``train``."""
    return f"""aggregate(transform(split({token}, ''), c -> instr('{ALPHABET}', c)), named_struct('s', 0.0D, 'a', 0),
        (acc, b) -> named_struct('s', acc.s + element_at({table}, acc.a * {SIZE} + b + 1), 'a', b), acc -> acc.s)"""


def scan(docs: DataFrame, text_col: str = "text", model: list[float] | None = None, nats_per_char: float = NATS_PER_CHAR, nats: float = NATS, out: str = "spans") -> DataFrame:
    """``docs`` with ``spans`` (or as ``out`` says): all spans (start, order of kind, end, kind), sorted.

    Null texts count as empty; a text without secrets has an empty array. Texts
    are scanned whole. The model's spans are runs of 12 characters or more with a
    ratio over ``nats`` in all and ``nats_per_char`` for each; they touch none of
    the rules', are no UUIDs and have ``DIFFERENT`` characters at least. Rows with null or repeated ids are scanned like any other. A
    column of ``docs`` of the name ``out`` is replaced, others stay, whatever
    their names.
    """
    if model is None:
        rows = docs.select(F.col(text_col).alias("text"))
        model = train(labelled_samples(rows, rows.select(F.xxhash64("text")).distinct().count()))
    df = docs.select(F.struct(*[docs[c] for c in docs.columns if c != out], F.lit(None).alias(unused("_", docs))).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("_secret_text"))
    taken = {k: f"_span_{k}" for k in KINDS}
    df = base_spans(df, "_secret_text", taken)
    df = located(df, taken["random"], "_secret_text", RUN, "true", "x")
    df = df.withColumn("_secret_table", F.lit(model))
    for k, name in enumerate(KINDS[:3]):
        df = df.withColumn(taken[name], F.expr(f"transform({taken[name]}, s -> named_struct('start', s.start, 'k', {k}, 'end', s.end, 'kind', '{name}'))"))
    df = df.withColumn("_secret_base", F.concat(*[F.col(taken[k]) for k in KINDS[:3]]))
    df = df.withColumn(taken["random"], F.expr(f"""filter({taken['random']}, s -> NOT exists(_secret_base, b -> b.start < s.end AND b.end > s.start)
        AND size(array_distinct(split(s.v, ''))) >= {DIFFERENT} AND NOT s.v RLIKE '{UUID}' AND {ratio_sql('s.v', '_secret_table')} > greatest({nats}D, {nats_per_char}D * (s.end - s.start)))"""))
    df = df.withColumn(out, F.array_sort(F.concat("_secret_base", F.expr(f"transform({taken['random']}, s -> named_struct('start', s.start, 'k', 3, 'end', s.end, 'kind', 'random'))"))))
    return df.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != out], out)


def base_spans(df: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """Adds the spans of the fixed rules, each kind under its name in ``names``."""
    quoted = ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    df = located(df, names["assign"], text, ASSIGN, f"length(regexp_extract(x, '{quoted}', 1)) >= {VALUE}")
    df = located(df, names["access"], text, ACCESS, "true")
    return located(df, names["hex"], text, HEX, "true")


def digest(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", model: list[float] | None = None) -> DataFrame:
    """``docs`` with each secret in the text replaced by ``mask``.

    Overlapping spans are replaced together; null texts stay null. Columns and
    their order are those of ``docs``.
    """
    spans = unused("_secret_spans", docs)
    df = scan(docs, text_col, model, out=spans)
    t = f"`{text_col}`"
    cut = F.expr(f"""CASE WHEN size({spans}) > 0 THEN aggregate({spans}, named_struct('at', 0, 'out', ''),
        (acc, s) -> CASE WHEN s.end <= acc.at THEN acc
            ELSE named_struct('at', s.end, 'out', concat(acc.out, CASE WHEN s.start >= acc.at THEN concat(substring({t}, acc.at + 1, s.start - acc.at), '{mask}') ELSE '' END)) END,
        acc -> concat(acc.out, substring({t}, acc.at + 1))) ELSE {t} END""")
    return df.withColumn(text_col, cut).select(*docs.columns)
