"""Records that differ only in formatting: canonical texts, and groups of records that share one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import Scratch

#: Full-width forms of ASCII and the ideographic space, by rule from their code points.
FULL = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)) + "　 "
HALF = "".join(chr(c) for c in range(0x21, 0x7F)) + "  "

FIELD = r"(?s)^\s*[\p{L}_][\p{L}\p{N}_ .-]*[=:]\s*\S.*$"
NAME = r"(?s)^([^=:]*)[=:]"


def letters(text: Column) -> Column:
    """Only the letters, marks and digits of a text."""
    return F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}]", "")


def with_canonical(df: DataFrame, text: str, out: str = "canonical") -> DataFrame:
    """``df`` with what is left of a text when letter case, width, white space, punctuation and symbols don't count.

    A JSON object, and a list of two or more ``name=value`` or ``name: value`` entries parted by line
    ends, ``;`` or ``|``, become the sorted list of their canonical names and values; fields of nested
    objects are sorted too. An object of one field is its name and value, like the text that has these
    only. NULL for a text without any letter or digit. The steps are columns of their own, so that
    none is computed twice."""
    plain, parts, fields, kept, bare = (F.col(c) for c in ("_plain", "_parts", "_fields", "_kept", "_bare"))
    listed = (F.size(parts) > 1) & F.forall(parts, lambda x: x.rlike(FIELD))
    of_list = F.transform(parts, lambda x: F.concat(letters(F.regexp_extract(x, NAME, 1)), F.lit("="), letters(F.regexp_replace(x, NAME, ""))))
    # A variant keeps the fields of its objects in order.
    nested = F.when(plain.rlike(r"(?s)\{.*\{"), F.to_json(F.try_parse_json(plain)))
    entries = F.map_entries(F.from_json(F.coalesce(nested, plain), "map<string,string>"))
    of_json = F.transform(entries, lambda e: F.concat(letters(e["key"]), F.lit("="), letters(F.coalesce(e["value"], F.lit("")))))
    done = df.withColumn("_plain", F.lower(F.translate(text, FULL, HALF)))
    done = done.withColumn("_parts", F.when(plain.rlike(r"[=:]"), F.filter(F.split(plain, r"[|;\r\n]+"), lambda x: F.trim(x) != "")))
    done = done.withColumn("_fields", F.coalesce(F.when(plain.rlike(r"(?s)^\s*\{.*\}\s*$"), of_json), F.when(listed, of_list)))
    done = done.withColumn("_kept", F.array_sort(F.filter(fields, lambda x: x != "=")))
    joined = F.when(F.size(kept) == 1, F.replace(kept[0], F.lit("="))).when(F.size(kept) > 1, F.concat(F.lit("{"), F.array_join(kept, "\n")))
    done = done.withColumn("_bare", F.when(kept.isNull() | (F.size(kept) == 0), letters(plain)))
    return done.withColumn(out, F.coalesce(joined, F.nullif(bare, F.lit("")))).drop("_plain", "_parts", "_fields", "_kept", "_bare")


def formatting_duplicates(records: DataFrame, key: str, text: str) -> DataFrame:
    """(canonical, group_id, copies, writings): one row per distinct canonical text; group_id is its smallest
    key, copies counts its records, writings its distinct raw texts. See formatting_groups for members."""
    return _grouped(records, key, text)[1].drop("digest")


def formatting_groups(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, group_id, copies): every record of a text that has a letter or digit; group_id is the smallest
    key with the same canonical text. Records with a NULL key or text have no row.

    Byte-identical texts are counted first, so only distinct texts are made canonical; these are grouped
    by their whole canonical text. Hot texts are combined before both shuffles. Groups are handed back to
    the texts and to the records by 128-bit digests, so that no text is shuffled for it; the join with
    records of a hot text is split by the adaptive planner."""
    raw, groups = _grouped(records, key, text)
    found = raw.select("raw_digest", "digest").join(groups.select("digest", "group_id", "copies"), "digest").drop("digest")
    rows = records.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), _digest(F.col(text)).alias("raw_digest"))
    return rows.join(found, "raw_digest").select(F.col("key").alias(key), "group_id", "copies")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _grouped(records: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    scratch = Scratch(records.sparkSession, "canonical")
    rows = records.select(F.col(key).alias("key"), F.col(text).alias("raw")).where("key is not null and raw is not null")
    raw = rows.groupBy("raw").agg(F.min("key").alias("first"), F.count("*").alias("copies"))
    # NULLs are left out after the table is written: earlier the condition would be moved below the counting,
    # and every row be made canonical.
    raw = with_canonical(raw, "raw").select(_digest(F.col("raw")).alias("raw_digest"), _digest(F.col("canonical")).alias("digest"), "canonical", "first", "copies")
    raw = scratch.save(raw).where("canonical is not null")
    groups = raw.groupBy("canonical").agg(F.min("first").alias("group_id"), F.sum("copies").alias("copies"), F.count("*").alias("writings"), F.first("digest").alias("digest"))
    return raw, groups
