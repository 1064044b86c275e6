"""Fill-in-the-middle: cut a text twice at token ends and move its middle to the back.

Tokens are found by repeated capture: the ``regex`` library keeps every repetition of a
group, so that one ``fullmatch`` of ``(unit)*`` gives all token ends at once; their number and
both cut offsets are read from that list, without walking over the matches.  Each repetition is
possessive: a token once taken is never given back, so matching is linear and leaves no
backtracking states, whatever the text's length.

Choices come from a hash of seed and key, so they do not depend on partitions or retries.
The regex runs in Arrow batches; offsets come back, and the text is put together in Spark.
"""
from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A token: leading spaces with a word, or spaces at the end of a text.
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def token_ends(pattern: regex.Pattern, text: str) -> list[int]:
    """Ends of all tokens, in code points, from the one match's captures."""
    return pattern.fullmatch(text).ends(1)


def cut_offsets(text: Column, first: Column, second: Column) -> Column:
    """Struct of ``n`` (tokens), ``a`` and ``b``: ends of the smaller and the larger of
    ``first % (n + 1)`` and ``second % (n + 1)`` tokens."""
    @F.arrow_udf("struct<n: long, a: long, b: long>")
    def cuts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        pattern = regex.compile(f"({UNIT})*+")
        out = []
        for i in range(len(texts)):  # one text as a Python string at a time
            ends = token_ends(pattern, texts[i].as_py() or "")
            n = len(ends)
            lo, hi = sorted((h1[i].as_py() % (n + 1), h2[i].as_py() % (n + 1)))
            out.append((n, ends[lo - 1] if lo else 0, ends[hi - 1] if hi else 0))
        n, a, b = zip(*out) if out else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (n, a, b)], names=["n", "a", "b"])

    return cuts(text, first, second)


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers from 0 to 2**32 - 1 per key: the first four 8-digit groups of the hex
    SHA-256 of seed, ``:`` and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42,
                   fim_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """All rows and columns of ``docs``, with ``fim``: a struct of ``n`` (tokens), ``form``
    (plain, psm or spm), ``prefix_chars`` and ``middle_chars`` (code points; null if plain)
    and ``output``.

    psm is ``<P>``prefix``<S>``suffix``<M>``middle, spm ``<S>``suffix``<P>``prefix``<M>``middle,
    plain the text itself: ``100 - fim_percent`` of a hundred texts, and all that are empty or
    contain a mark, since marks in a text could not be told from the format's own.

    A null text counts as empty; a null key draws like an empty one; repeated keys draw alike,
    each for its own row; whole texts of any length are matched; an empty table gives no rows.  A
    column of ``docs`` that is called ``fim`` itself is replaced.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(f"`{key}`"), seed)
    cut = docs.withColumn("fim", cut_offsets(t, h1, h2))
    n, a, b = (F.col("fim")[x] for x in ("n", "a", "b"))
    plain = (t == "") | (h3 % 100 >= fim_percent)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(t, F.lit(mark))
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    prefix, middle = F.substring(t, F.lit(1), a), F.substring(t, a + 1, b - a)
    suffix = F.substring(t, b + 1, F.length(t))
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = (F.when(plain, t).when(form == "spm", F.concat(s, suffix, p, prefix, m, middle))
              .otherwise(F.concat(p, prefix, s, suffix, m, middle)))
    return cut.withColumn("fim", F.struct(
        n.alias("n"), form.alias("form"), F.when(~plain, a).alias("prefix_chars"), F.when(~plain, b - a).alias("middle_chars"),
        output.alias("output")))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from, from output and form alone.

    Texts with marks stay plain and no mark begins inside another, so each mark of a psm or
    spm output occurs once."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    psm = F.concat(F.substring(F.substring_index(head, SUFFIX, 1), F.lit(4), F.length(head)), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, F.substring(F.substring_index(head, PREFIX, 1), F.lit(4), F.length(head)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
