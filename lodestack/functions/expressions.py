"""Scalar functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bare_digest(d: Column) -> Column:
    return F.substring_index(d, ":", -1)


def is_digest(d: Column) -> Column:
    return d.rlike("^[0-9a-fA-F]{64}$")


def chunk_end(length: Column, size: Column, idx: Column) -> Column:
    """Last byte of a chunk, inclusive."""
    return F.least(idx * size + size - 1, length - 1)


def human_bytes(n: Column, last: str = "EB") -> Column:
    """1024-based size with one decimal above bytes, up to the unit `last`; missing: a dash. A tie goes to the even digit."""
    every = ["B", "KB", "MB", "GB", "TB", "PB", "EB"]
    out = F.concat(n.cast("string"), F.lit(" B"))
    for k, unit in enumerate(every[1 : every.index(last) + 1], 1):
        out = F.when(n >= 1024**k, F.format_string(f"%.1f {unit}", F.bround(n / 1024**k, 1))).otherwise(out)
    return F.when(n.isNull(), "—").otherwise(out)


def one_decimal(n: Column, unit: int) -> Column:
    """The double n / unit with one decimal, rounded by its exact binary value, where n / unit is below 2**11.

    Only where the decimal value is a tie does the binary one matter; it is then compared in whole numbers.
    """
    tenth = unit // 10
    whole, rest = F.floor(n / tenth).cast("long"), n % tenth
    high = F.floor(n / unit * 2**20)
    binary = high.cast("decimal(38,0)") * 2**32 + ((n / unit * 2**20 - high) * 2**32).cast("decimal(38,0)")
    over = binary * F.lit(unit).cast("decimal(11,0)") - n.cast("decimal(20,0)") * 2**52
    up = F.when(rest * 2 > tenth, 1).when(rest * 2 < tenth, 0).when(over > 0, 1).when(over < 0, 0).otherwise(whole % 2)
    return F.concat(F.floor((whole + up) / 10).cast("string"), F.lit("."), ((whole + up) % 10).cast("string"))


def human_params(n: Column) -> Column:
    """Billions and millions with one decimal, less with grouped digits; missing or 0: a dash."""
    out = F.when(n >= 10**9, F.concat(one_decimal(n, 10**9), F.lit("B"))).when(n >= 10**6, F.concat(one_decimal(n, 10**6), F.lit("M"))).otherwise(F.format_number(n, 0))
    return F.when(F.coalesce(n, F.lit(0)) == 0, "—").otherwise(out)


def digest_bytes(d: Column) -> Column:
    """The 32 bytes of a digest of just 64 hexadecimal digits; null for any other text."""
    return F.when(is_digest(d), F.unhex(d))


def utc_time(text: Column) -> Column:
    """An ISO time with `Z` or an offset as UTC with microseconds and `Z`; null if it is none. The session's zone is UTC."""
    made = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"), text).try_cast("timestamp")
    return F.date_format(made, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def decode_base64url(part: Column) -> Column:
    """Text of a URL-safe base64 part without padding; null if it isn't one."""
    plain = F.translate(part, "-_", "+/")
    padded = F.concat(plain, F.repeat(F.lit("="), F.pmod(-F.length(plain), F.lit(4)).cast("int")))
    return F.try_to_binary(padded, F.lit("base64")).try_cast("string")


def token_expiry(token: Column) -> Column:
    """`exp` of a token of three parts whose middle one is an object with a number there; else null."""
    parts = F.split(token, r"\.", -1)
    body = F.when(F.size(parts) == 3, decode_base64url(F.get(parts, F.lit(1))))
    value = F.try_parse_json(body)
    exp = F.try_variant_get(value, "$.exp", "variant")
    return F.when(F.schema_of_variant(exp).rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.try_variant_get(value, "$.exp", "double"))


def basic_user(header: Column) -> Column:
    """The name before `:` in a basic login's base64 text."""
    return F.split(F.try_to_binary(header, F.lit("base64")).try_cast("string"), ":", 2)[0]


def lookup_outcome(status: Column) -> Column:
    """Three states that must not be mixed up: found, missing (404), forbidden (401, 403)."""
    return F.when(status.isin(401, 403), "forbidden").when(status == 404, "missing").otherwise("found")


def registry(given: Column, default: str) -> Column:
    """The given address, or the default for an empty one, without slashes at its end."""
    return F.regexp_replace(F.coalesce(F.nullif(given, F.lit("")), F.lit(default)), "/+$", "")


def repository_path(name: Column, kind: Column) -> Column:
    """The path of a repository by kind; null where a name of a dataset or space has such a prefix already."""
    prefix = F.when(kind == "dataset", "datasets/").when(kind == "space", "spaces/").otherwise("")
    return F.when((prefix != "") & name.rlike("^(datasets|spaces)/"), F.lit(None)).otherwise(F.concat(prefix, name))


#: exit codes of kinds of errors, the more special kinds first, as the first that fits counts: fixed values
EXIT_CODES = (
    ("LocalEntryNotFoundError", 13),
    ("EntryNotFoundError", 10),
    ("GatedRepoError", 14),
    ("DisabledRepoError", 14),
    ("RepositoryNotFoundError", 11),
    ("RevisionNotFoundError", 12),
    ("ConcurrentManifestUpdateError", 15),
    ("HfHubHTTPError", 16),
)


def exit_code(kinds: Column) -> Column:
    """The exit code of an error whose own kind and kinds above it are in the array; 1 where none is known."""
    out = F.lit(1)
    for kind, code in reversed(EXIT_CODES):
        out = F.when(F.array_contains(kinds, kind), code).otherwise(out)
    return out


def split_ranges(total: Column, parts: Column) -> Column:
    """Array of (first, last) inclusive: at most `parts` ranges of equal size, the last one shorter; none for nothing."""
    size = F.ceil(total / parts).cast("long")
    n = F.ceil(total / size).cast("long")
    one = lambda i: F.struct((i * size).alias("first"), (F.least((i + 1) * size, total) - 1).alias("last"))
    return F.when((total > 0) & (parts > 0), F.transform(F.sequence(F.lit(0).cast("long"), n - 1), one)).otherwise(F.array().cast("array<struct<first:bigint,last:bigint>>"))


def leading_version(v: Column) -> Column:
    """Leading integers of the dotted parts, up to the first part without one."""
    parts = F.split(v, "\\.")
    digits = F.transform(parts, lambda p: F.regexp_extract(p, r"^(\d*)", 1))
    upto = F.array_position(digits, "")
    return F.transform(F.when(upto > 0, F.slice(digits, 1, (upto - 1).cast("int"))).otherwise(digits), lambda d: d.cast("long"))


def committed_bytes(r: Column) -> Column:
    """Bytes that a range header confirms: one more than the number after its last `-` (or than the whole text); 0 for 0 and for anything else."""
    end = F.trim(F.substring_index(r, "-", -1)).try_cast("bigint")
    return F.when(end > 0, F.coalesce(F.try_add(end, F.lit(1)), F.lit(2**63 - 1))).otherwise(F.lit(0).cast("long"))


def retryable(status: Column) -> Column:
    return status.isin(408, 429) | status.between(500, 599)


def ref_name(revision: Column) -> Column:
    return F.when(revision == "main", "refs/heads/main").otherwise(F.concat(F.lit("refs/tags/"), revision))


def safe_path(path: Column) -> Column:
    """Relative and without a `..` segment, by either separator."""
    plain = F.replace(path, F.lit("\\"), F.lit("/"))
    return ~plain.startswith("/") & ~F.array_contains(F.split(plain, "/"), "..")


def named_digests(message: Column) -> Column:
    """The digests that a text names, once each, in order."""
    return F.array_distinct(F.regexp_extract_all(message, F.lit("sha256:[0-9a-f]{64}"), F.lit(0)))


def explanation(message: Column, said: tuple[tuple[str, str], ...]) -> Column:
    """What is said of the first name that the text before the first `:` holds."""
    kind, out = F.substring_index(message, ":", 1), F.lit(None).cast("string")
    for name, text in reversed(said):
        out = F.when(F.contains(kind, F.lit(name)), text).otherwise(out)
    return out


def first_own_frame(trace: Column) -> Column:
    """`file:line` of the first line of a traceback that is not in a library."""
    own = F.filter(F.split(trace, "\n"), lambda x: x.rlike(r"^\S+\.py:\d+:") & ~F.contains(F.regexp_extract(x, r"^(\S+\.py):\d+:", 1), F.lit("site-packages")))
    return F.regexp_extract(F.get(own, F.lit(0)), r"^(\S+\.py:\d+):", 1)
