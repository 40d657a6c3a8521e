"""Accessions, strains, serotypes, segments, comments and other texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandlake.functions.blanks import blank_in_curation


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def first_token(header: Column) -> Column:
    return F.split(F.trim(header), r"\s+")[0]


def accession(header: Column) -> Column:
    """First token, without its version."""
    return F.substring_index(first_token(header), ".", 1)


def without_version(acc: Column, last_dot: bool = False) -> Column:
    """Everything before the first dot, or before the last one."""
    return F.regexp_replace(acc, r"\.[^.]*$", "") if last_dot else F.substring_index(acc, ".", 1)


def accession_base(acc: Column) -> Column:
    return F.nullif(without_version(F.trim(acc), last_dot=True), F.lit(""))


def accession_version(acc: Column) -> Column:
    """The number after the last dot; null if there is none."""
    return found(F.trim(acc), r"\.([^.]*)$").try_cast("int")


def country_part(c: Column) -> Column:
    return F.split_part(c, F.lit(":"), F.lit(1))


def locality_part(c: Column) -> Column:
    """Only the second piece, with its leading blank."""
    return F.split_part(c, F.lit(":"), F.lit(2))


def host_name(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"\s*\([^)]*\)", "")


def strain_in(definition: Column) -> Column:
    """The first parenthesis up to its first closing one, cut before a subtype or 'mixed'."""
    inner = F.regexp_extract(definition, r"(?<=\()(.*?)(?=\))", 1)
    cut = F.regexp_extract(inner, r"^(.*?)(?=\(H|\(mixed)", 1)
    return F.when(inner.rlike(r"\(H|\(mixed"), cut).otherwise(inner)


def clean_strain(c: Column) -> Column:
    for pattern, into in ((r"\(H\d{1}N\d{1}\)", ""), (r"[^a-zA-Z0-9/_-]", "_"), (r"_+", "_"), (r"[_/]+$", "")):
        c = F.regexp_replace(c, pattern, into)
    return c


def serotype_source(serotype: Column, definition: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(serotype), F.lit("")), F.regexp_extract(F.coalesce(definition, F.lit("")), r"\((H\d{1,2}N\d{1,2})\)", 1))


def serotype(raw: Column, curated: Column | None = None) -> Column:
    """HxNy, Hx or Ny; else the curated value (a lookup by serotype_key), else 'unknown'. Empty stays empty.

    Wildcard forms (H?N2, H1NX) come to what their digits say, because the forms with digits are tried first.
    """
    key = serotype_key(raw)
    prefixed = F.upper(found(F.trim(raw), r"(?i)^[ABCD]\s*/\s*(H\d{1,2}(?:N\d{1,2})?|N\d{1,2})$"))
    known = F.coalesce(prefixed, *(found(key, p) for p in (r"(H\d{1,2}N\d{1,2})", r"(H\d{1,2})", r"(N\d{1,2})")), *([curated] if curated is not None else []), F.lit("unknown"))
    return F.when(F.coalesce(raw, F.lit("")) == "", "").otherwise(known)


def serotype_key(raw: Column) -> Column:
    return F.regexp_replace(F.upper(raw), "[ /-]", "")


# Where a segment number stands in a key, in the order in which they are tried.
SEGMENT_PATTERNS = [
    r"(?:^|[_-])segment[_-]?(\d+)(?:$|[_-])",
    r"(?:^|[_-])seg[_-]?(\d+)(?:$|[_-])",
    r"(?:^|[_-])refset[_-]?(\d+)(?:$|[_-])",
    r"(?:^|[_-])(\d+)(?:$|[_-])",
]


def segment_number(key: Column) -> Column:
    return F.coalesce(found(F.trim(key), r"^(\d+)$"), *(found(F.trim(key), f"(?i){p}") for p in SEGMENT_PATTERNS))


def first_digits(c: Column) -> Column:
    return found(c, r"(\d+)")


def items(c: Column, separator: str = ";") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != "")


def collapsed(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")


def append_item(comment: Column, new: Column) -> Column:
    """Append a curated item unless an equal one, blanks collapsed and case ignored, is there."""
    there = F.transform(items(comment), collapsed)
    joined = F.array_join(F.when(F.array_contains(there, collapsed(new)), items(comment)).otherwise(F.array_append(items(comment), F.trim(new))), "; ")
    return F.when(blank_in_curation(new), comment).otherwise(joined)


def append_unless_inside(comment: Column, new: Column) -> Column:
    """Append a remark unless the comment holds it as a substring, blanks collapsed and case ignored."""
    comment, new = F.coalesce(comment, F.lit("")), F.coalesce(new, F.lit(""))
    squeeze = lambda c: F.regexp_replace(F.lower(c), r"\s+", " ")
    kept = F.btrim(comment, F.lit(" ;|"))
    return F.when((new == "") | (F.instr(squeeze(comment), squeeze(new)) > 0), kept).when(F.trim(comment) == "", F.trim(new)).otherwise(F.concat(kept, F.lit("; "), F.trim(new)))


def clean_separators(c: Column) -> Column:
    """Drop NA at either end and doubled separators. NA needs no word end, so 'Namibia' loses its first letters."""
    c = F.regexp_replace(c, r"(?i)(^\s*NA\s*;?\s*|\s*;?\s*NA\s*$)", "")
    return F.btrim(F.regexp_replace(c, r"\s*;\s*;\s*", "; "), F.lit(" ;"))


def clean_remark(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"(?i)(^NA[;| ]*|[;| ]*NA$)", ""), F.lit(" ;|"))


def without_curators(c: Column) -> Column:
    return F.array_join(F.filter(items(c), lambda x: ~F.lower(x).startswith("curator:")), "; ")


def joined(*parts: Column, separator: str = "; ") -> Column:
    """The parts that are not empty."""
    return F.array_join(F.filter(F.array(*parts), lambda x: F.coalesce(x, F.lit("")) != ""), separator)


def appended_reason(existing: Column, reason: Column) -> Column:
    existing = F.coalesce(existing, F.lit(""))
    return F.when(existing == "", reason).otherwise(F.concat(existing, F.lit("; "), reason))


def filtering_reason(error: Column, reference: Column) -> Column:
    error, reference = (F.trim(F.coalesce(c, F.lit(""))) for c in (error, reference))
    return F.when(error != "", F.concat(F.lit("alignment_filtering: "), error)).when(reference != "", F.concat(F.lit("alignment_filtering: filtered against reference "), reference)).otherwise("alignment_filtering")


# Words for a new and for a changed store.
NEW_STORE = ["new", "new db", "create", "created", "fresh"]
CHANGED_STORE = ["modified", "update", "updated", "changed"]


def store_status(c: Column) -> Column:
    word = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(word.isin(NEW_STORE), "new db").when(word.isin(CHANGED_STORE), "last updated").otherwise(c)


def gene_symbol(product: Column) -> Column:
    return F.element_at(F.split(F.trim(product), r"\s+"), -1)


def product_name(product: Column) -> Column:
    return F.trim(F.replace(product, gene_symbol(product), F.lit("")))


def first_attribute(attributes: Column, names: list[str], default: str = "NA") -> Column:
    return F.coalesce(*(F.nullif(F.trim(attributes[name]), F.lit("")) for name in names), F.lit(default))
