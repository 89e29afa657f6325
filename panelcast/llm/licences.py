"""Whole-text licence lookup by canonical digest.

A text is brought to a canonical form (lower case, no copyright lines, equivalent spellings
unified, punctuation and spacing reduced to single spaces) and hashed; the digest is joined with
the digests of known licences, which go through the same expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.licence_digests import LICENCE_DIGESTS
from panelcast.llm.licence_texts import KNOWN_LICENCES

# Whole lines that name a holder or a year, behind comment marks or not, after
# lower-casing.  Lines of a body that merely begin with the word stay.
COPYRIGHT_LINE = (
    r"(?:^|\n)[ \t/*#;%!|>'-]*(?:"
    r"(?:portions[ \t]+)?copyright[ \t:]*(?:\(c\)|©|&copy;|(?:19|20)[0-9]{2}|by[ \t]|[<\[{](?:year|yyyy)"
    r"|the[ \t][^\n]*(?:authors|contributors|developers|foundation|project|team)[ \t.,]*(?=\n|$))[^\n]*"
    r"|\(c\)[ \t]*(?:copyright|(?:19|20)[0-9]{2}|by[ \t]|[<\[{](?:year|yyyy))[^\n]*"
    r"|©[^\n]*"
    r"|all rights reserved[ \t.,;!*/#-]*(?=\n|$))"
)

# Spellings that licence matching treats as equal, as whole words.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("modelled", "modeled"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("wilful", "willful"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("https", "http"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """The canonical form of a text; null stays null, a text without letters or digits is empty.

    Only A-Z is lower-cased and only ASCII letters, digits and characters beyond ASCII are kept
    as words, so that every engine gives the same form.
    """
    out = F.translate(text, _UPPER + "\r", _LOWER + "\n")
    out = F.regexp_replace(out, COPYRIGHT_LINE, "\n")
    out = F.concat(F.lit(" "), F.regexp_replace(out, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), F.lit(" "))
    for old, new in SPELLINGS:
        # twice: neighbours share the space between them
        for _ in range(2):
            out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def licence_digests(
    spark, texts: Sequence[tuple[str, str]] = KNOWN_LICENCES, digests: Sequence[tuple[str, str]] = LICENCE_DIGESTS
) -> DataFrame:
    """``digest``, ``licence`` from (name, text) and (name, digest) pairs: one row per canonical text, the first name of equal ones."""
    rows = spark.createDataFrame(list(texts), "licence string, text string")
    named = rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "licence")
    named = named.unionByName(spark.createDataFrame(list(digests), "licence string, digest string"))
    return named.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan_licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``canonical_sha256``, ``licence`` for every row of ``docs``.

    ``canonical_sha256`` is the lower-case hex digest of the whole canonical text, null for a null
    text; ``licence`` is null where no known licence has that digest.  Rows are kept as they are,
    repeated or not; other columns are not read.
    """
    known = licence_digests(docs.sparkSession) if known is None else known
    hashed = docs.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256"))
    return hashed.join(known.withColumnRenamed("digest", "canonical_sha256"), "canonical_sha256", "left").select(
        "doc_id", "canonical_sha256", "licence"
    )
