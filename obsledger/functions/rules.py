"""Rules over header tags, identifiers and input paths, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V


def tag(tags: Column, name: str) -> Column:
    """Value of a tag, null when absent."""
    return F.try_element_at(tags, F.lit(name))


def has_value(tags: Column, name: str) -> Column:
    return F.coalesce(tag(tags, name), F.lit("")) != ""


def missing_of(tags: Column, names: Sequence[str]) -> Column:
    """Those of `names` that are absent or empty, in the order given."""
    return F.array_compact(F.array(*[F.when(~has_value(tags, n), F.lit(n)) for n in names]))


def identity_tags(tags: Column) -> Column:
    """The identity tags that have a value."""
    return F.map_filter(tags, lambda k, v: k.isin(V.IDENTITY_TAGS) & (F.coalesce(v, F.lit("")) != ""))


def has_pixels(tags: Column) -> Column:
    return F.exists(F.map_keys(tags), lambda k: k.isin(V.PIXEL_TAGS))


def tag_validation(tags: Column, required: Sequence[str] = tuple(V.MANDATORY_TAGS), strict: bool = False) -> Column:
    """`invalid` if a required tag has no value, `incomplete` if strict and a recommended one has none."""
    verdict = F.when(F.size(missing_of(tags, required)) > 0, "invalid")
    if strict:
        verdict = verdict.when(F.size(missing_of(tags, V.RECOMMENDED_TAGS)) > 0, "incomplete")
    return verdict.otherwise("valid")


def is_dotted_number(uid: Column) -> Column:
    """At least two parts, all digits."""
    return F.coalesce(uid.rlike(r"^[0-9]+(\.[0-9]+)+$"), F.lit(False))


def uid_errors(uid: Column) -> Column:
    """Names of the UID rules that are broken."""
    empty = F.coalesce(uid, F.lit("")) == ""
    rules = {
        "too_long": F.length(uid) > V.MAX_UID,
        "invalid_characters": ~uid.rlike(V.UID),
        "consecutive_dots": uid.contains(".."),
        "starts_with_dot": uid.startswith("."),
        "ends_with_dot": uid.endswith("."),
    }
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return F.when(empty, F.array(F.lit("empty"))).otherwise(broken)


def header_uid_errors(tags: Column) -> Column:
    """A message for each of the header's UID tags that has a value of the wrong form."""
    wrong = [
        F.when(has_value(tags, n) & ~is_dotted_number(tag(tags, n)), F.concat(F.lit(f"Invalid UID format in {n}: "), tag(tags, n)))
        for n in V.UID_TAGS
    ]
    return F.array_compact(F.array(*wrong))


def path_errors(path: Column, is_file_name: bool = False) -> Column:
    """Names of the path rules that are broken; of the dangerous patterns only the first is named."""
    empty = F.coalesce(path, F.lit("")) == ""
    dangerous = F.coalesce(*[F.when(path.contains(p), F.lit(f"dangerous_{p}")) for p in V.DANGEROUS])
    found = [
        F.when(F.length(path) > V.MAX_INPUT_PATH, "too_long"),
        F.when(path.contains("\0"), "null_byte"),
        F.when(path.rlike(V.CONTROL), "control_chars"),
        F.when(path.rlike(V.TRAVERSAL), "path_traversal"),
        dangerous,
    ]
    if is_file_name:
        dots = F.length(path) - F.length(F.replace(path, F.lit("."), F.lit("")))
        found.append(F.when(dots > 2, "multiple_extensions"))
    return F.when(empty, F.array(F.lit("empty"))).otherwise(F.array_compact(F.array(*found)))


def sanitized_path(path: Column) -> Column:
    """The path itself when it breaks no rule, else without control characters and parent steps."""
    cleaned = F.regexp_replace(path, V.CONTROL, "")
    for step in ("../", "..\\"):
        cleaned = F.replace(cleaned, F.lit(step), F.lit(""))
    return F.when(F.size(path_errors(path)) == 0, path).when(F.coalesce(path, F.lit("")) != "", cleaned)


def normalized_path(path: Column) -> Column:
    """Path without empty, `.` and resolvable `..` steps."""
    absolute = path.startswith("/")
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    nothing = F.array().cast("array<string>")

    def take(done: Column, step: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        can_go_up = (F.size(done) > 0) & (last != "..")
        return (
            F.when((step == "..") & can_go_up, F.slice(done, 1, F.size(done) - 1))
            .when((step == "..") & absolute, done)
            .otherwise(F.concat(done, F.array(step)))
        )

    joined = F.array_join(F.aggregate(steps, nothing, take), "/")
    return F.when(absolute, F.concat(F.lit("/"), joined)).when(joined == "", ".").otherwise(joined)


@dataclass(frozen=True)
class TagField:
    """One entry of a tag schema: which tag to take, under which name, how."""

    tag: str
    alias: str
    required: bool = False
    transform: str | None = None

    def column(self, tags: Column) -> Column:
        value = tag(tags, self.tag)
        if self.transform == "uppercase":
            value = F.upper(value)
        elif self.transform == "lowercase":
            value = F.lower(value)
        return value.alias(self.alias)


def tag_schema_apply(df: DataFrame, tags: Column, schema: Sequence[TagField], keep: Sequence[str] = ()) -> DataFrame:
    """One column per schema entry; rows that lack a required tag fail with a message."""
    absent = F.concat_ws(", ", *[F.when(tag(tags, f.tag).isNull(), F.lit(f.alias)) for f in schema if f.required])
    return df.select(
        *keep,
        *[f.column(tags) for f in schema],
        (absent == "").alias("success"),
        F.when(absent != "", F.concat(F.lit("Missing required tags: "), absent)).alias("error"),
    )


def _first_match(text: Column, patterns: Sequence[str]) -> Column:
    """First group of the first pattern that matches."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])


def _names_vendor(manufacturer: Column, names: Sequence[str]) -> Column:
    upper = F.upper(F.coalesce(manufacturer, F.lit("")))
    hit = F.lit(False)
    for name in names:
        hit = hit | upper.contains(name)
    return hit


def meas_uid_vendor_a(manufacturer: Column, modality: Column, blocks: Sequence[Column]) -> Column:
    """Measurement id out of the private blocks, the first block that holds one."""
    guard = _names_vendor(manufacturer, V.VENDOR_A_NAMES) & F.upper(modality).isin(V.VENDOR_A_MODALITIES)
    found = [F.when(b.contains("MeasUID"), _first_match(b, V.MEAS_UID_PATTERNS_A)) for b in blocks]
    return F.when(guard, F.coalesce(*found))


def meas_uid_vendor_b(
    manufacturer: Column, modality: Column, blocks: Sequence[Column], series_description: Column, comments: Sequence[Column]
) -> Column:
    """Measurement id out of private blocks, series description or comments, without separators."""
    guard = _names_vendor(manufacturer, V.VENDOR_B_NAMES) & F.upper(modality).isin(V.VENDOR_B_MODALITIES)
    found = F.coalesce(
        *[_first_match(b, V.MEAS_UID_PATTERNS_B) for b in blocks],
        _first_match(series_description, V.SERIES_TEXT_PATTERNS_B),
        *[_first_match(c, V.MEAS_UID_PATTERNS_B) for c in comments],
    )
    return F.when(guard, F.translate(found, "-_\r\n", ""))


def vendor_normalize(vendor: Column) -> Column:
    """Standard vendor name of the first alias found, else the name itself in upper case."""
    upper = F.upper(vendor)
    result = F.when(F.coalesce(vendor, F.lit("")) == "", "GENERIC")
    for standard, aliases in V.VENDOR_ALIASES.items():
        result = result.when(upper.rlike("|".join(aliases)), standard)
    return result.otherwise(F.substring(upper, 1, 32))


def safe_int(text: Column) -> Column:
    return text.try_cast("int")


def text_of_bytes(raw: Column) -> Column:
    """UTF-8 text of bytes, broken sequences replaced."""
    return F.make_valid_utf8(raw.cast("string"))


def tag_json(tags: Column, raw: Column | None = None, dates: Column | None = None) -> Column:
    """Tags as JSON text in order of their names, null when there are none.

    `tags`, `raw` and `dates` are maps from name to text, bytes and dates. Bytes become text
    with broken sequences replaced, dates their ISO form. A name stands in one map only.
    """
    entries = [F.map_entries(tags)]
    if raw is not None:
        entries.append(F.map_entries(F.transform_values(raw, lambda _, v: text_of_bytes(v))))
    if dates is not None:
        entries.append(F.map_entries(F.transform_values(dates, lambda _, v: v.cast("string"))))
    every = F.concat(*[F.coalesce(e, F.array().cast("array<struct<key:string,value:string>>")) for e in entries])
    return F.when(F.size(every) > 0, F.to_json(F.map_from_entries(F.array_sort(every))))


def looks_like_image(content: Column, magic: bytes = V.MAGIC, offset: int = V.MAGIC_OFFSET) -> Column:
    """The format's magic bytes stand at their place."""
    here = F.substring(content, offset + 1, len(magic))
    return (F.octet_length(content) >= offset + len(magic)) & (F.hex(here) == magic.hex().upper())
