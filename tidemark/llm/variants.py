"""Spelling variants by anagram hashing.

A word's key is the sum of the fifth powers of its letters' code points, the
same for all anagrams. An added or removed letter changes the key by that
letter's power, an exchanged one by the difference of two. So two words at one
edit meet under a key less the power of one letter: the shorter word's own key,
or, for an exchange, what both keep. Each word is dealt out under its own key
and its key less each of its letters, words that meet are joined, and the order
of their letters is verified. No two differences of the powers of letters up to
U+00FF are equal, and none is a power itself, so that there a pair at one edit
meets once; powers of other letters are reduced to the same size and may coincide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dealt_out, discard, stash

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Powers and keys count modulo these; the fifth powers of code points up to 255 are smaller.
POWERS, KEYS = (1 << 41) - 1, (1 << 61) - 1
#: Words under one key from which on they meet under what remains of them too.
CROWDED = 256


def power(letter: Column) -> Column:
    """Fifth power of a letter's code point."""
    code = F.ascii(letter).cast("long")
    power = code
    for _ in range(4):
        power = power * code % POWERS
    return power


def letters(word: Column) -> Column:
    return F.split(word, "")


def anagram_key(word: Column) -> Column:
    """Sum of the powers of all letters."""
    return F.aggregate(letters(word), F.lit(0).cast("long"), lambda s, c: (s + power(c)) % KEYS)


def less(key: Column, letter: Column) -> Column:
    """The key of what an added or removed letter leaves."""
    return F.pmod(key - power(letter), F.lit(KEYS))


def without(word: Column, at: Column) -> Column:
    """``word`` less its code point at ``at``, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), at.cast("int")), F.substring(word, (at + 2).cast("int"), F.length(word)))


def runs(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``run``: each match of ``pattern``, A-Z lower-cased. Null texts have none."""
    text = F.translate(F.col(text_col).cast("string"), ASCII_UPPER, ASCII_LOWER)
    keep = [F.col(c) for c in docs.columns if c.lower() not in (text_col.lower(), "run")]
    return docs.select(*keep, F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("run"))


def count_words(words: DataFrame, min_length: int = 6, min_n: int = 5) -> DataFrame:
    """``(word, n)`` of the column ``word``: words of ``min_length`` code points that occur ``min_n`` times."""
    long = words.where(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_n)


def near_pairs(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``(word, other, other_n)``: each pair of distinct words at one inserted, deleted or replaced code point, both ways.

    Each pair comes once each way. ``words`` holds ``(word, n)``, each word once.
    """
    keyed = words.where(F.length("word") > 0).withColumn("full", anagram_key(F.col("word")))
    shorter = F.transform(F.array_distinct(letters(F.col("word"))), lambda c: less(F.col("full"), c))
    dealt = keyed.select("word", "n", "full", F.explode(F.array_distinct(F.concat(F.array("full"), shorter))).alias("key"))
    met = dealt.groupBy("key").agg(F.count("*").alias("met")).where("met > 1")
    dealt = stash(dealt.join(dealt_out(met), "key"))
    pairs = _meeting(dealt.where(F.col("met") <= crowded), "key")
    # where many words meet, those at one edit also agree in what remains of them, letter for letter
    at = F.sequence(F.lit(0), F.length("word") - 1)
    rest = F.transform(F.filter(at, lambda i: less(F.col("full"), F.substring("word", i + 1, F.lit(1))) == F.col("key")), lambda i: F.xxhash64(without(F.col("word"), i)))
    rest = F.when(F.col("full") == F.col("key"), F.array(F.xxhash64("word"))).otherwise(F.array_distinct(rest))
    crowd = dealt.where(F.col("met") > crowded).withColumn("rest", F.explode(rest))
    pairs = pairs.union(_meeting(crowd, "key", "rest")).distinct()
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    return pairs.select(F.inline(both))


def _meeting(dealt: DataFrame, *keys: str) -> DataFrame:
    """``(a, a_n, b, b_n)``: verified pairs of words under equal keys, a before b."""
    a = dealt.select(*keys, F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("full").alias("a_full"))
    b = dealt.select(*keys, F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("full").alias("b_full"))
    near = (F.col("a") < F.col("b")) & (F.col("a_full") != F.col("b_full")) & (F.levenshtein("a", "b", 1) == 1)
    return a.join(dealt_out(b), list(keys)).where(near).select("a", "a_n", "b", "b_n")


def group_variants(words: DataFrame, ratio: int = 5, crowded: int = CROWDED) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of each word of ``(word, n)``.

    ``form`` is the most frequent word at one edit (of equal ones the first in
    code-point order) if it is ``ratio`` times as frequent at least, else null;
    ``root`` is where following forms ends, the word itself without one;
    ``n_near`` counts the words at one edit. Null words are left out, an empty
    word is near none; of repeated words the counts add up. ``ratio`` must be
    above 1, so that forms never go in a circle.
    """
    words = stash(words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_pairs(words, crowded).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(dealt_out(near), "word", "left")
    enough = -F.col("best.less") >= F.col("n") * ratio
    found = stash(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    ends = _ends(found.where("form IS NOT NULL").select("word", F.col("form").alias("end")))
    out = found.join(dealt_out(ends), "word", "left")
    return out.select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")


def _ends(steps: DataFrame) -> DataFrame:
    """``(word, end)``: the last of each chain of steps, by doubling the steps until none goes on."""
    steps = stash(steps)
    while True:
        onward = steps.select(F.col("word").alias("end"), F.col("end").alias("next"))
        longer = stash(steps.join(dealt_out(onward), "end", "left").select("word", F.coalesce("next", "end").alias("end"), F.col("next").isNotNull().alias("moved")))
        moved = longer.where("moved").limit(1).count()
        discard(steps)
        steps = longer.drop("moved")
        steps._stashed_at = longer._stashed_at
        if not moved:
            return steps
