"""Document URI rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a URI path may carry unescaped; non-ASCII letters also stay, controls and spaces do not.
_LEGAL = r"^[A-Za-z0-9_\-!.~'()*,;:$&+=@/]$|^[^\x00-\x7F\p{Cc}\p{Z}]$"


def parse_replace_option(text: str) -> list[tuple[str, str]]:
    """Parse ``regex,'replacement',regex,'replacement'`` into pairs."""
    parts = text.split(",")
    if len(parts) % 2:
        raise ValueError(f"uri replace needs pairs of pattern and replacement: {text}")
    pairs = []
    for pattern, quoted in zip(parts[::2], parts[1::2]):
        quoted = quoted.strip()
        if len(quoted) < 2 or not (quoted.startswith("'") and quoted.endswith("'")):
            raise ValueError(f"replacement must be in single quotes: {quoted}")
        pairs.append((pattern, quoted[1:-1]))
    return pairs


def uri_replace(uri: Column, pairs: list[tuple[str, str]] | str | None) -> Column:
    """Apply each (regex, replacement) to the whole URI, in order."""
    if isinstance(pairs, str):
        pairs = parse_replace_option(pairs)
    for pattern, replacement in pairs or []:
        uri = F.regexp_replace(uri, F.lit(pattern), F.lit(replacement))
    return uri


def uri_prefix_suffix(uri: Column, prefix: str | None = None, suffix: str | None = None) -> Column:
    return F.concat(F.lit(prefix or ""), uri, F.lit(suffix or ""))


def uri_encode(uri: Column) -> Column:
    """Percent-encode what a URI path may not carry; ``/`` stays."""
    encoded = F.array_join(
        F.transform(
            F.split(uri, ""),
            lambda c: F.when(c.rlike(_LEGAL), c).otherwise(
                F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")
            ),
        ),
        "",
    )
    # Most URIs are already legal: skip the per-character work for them.
    return F.when(uri.rlike(r"^[A-Za-z0-9_\-!.~'()*,;:$&+=@/]*$"), uri).otherwise(encoded)


def uri_encode_error(uri: Column) -> Column:
    """Why the text cannot become a URI, or null."""
    scheme = F.regexp_extract(uri, r"^([^/:]*):", 1)
    has_scheme = uri.rlike(r"^[^/:]*:")
    good = F.regexp_extract(uri, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*)?", 0)
    return (
        F.when(has_scheme & (scheme == ""), F.concat(F.lit("Expected scheme name at index 0: "), uri))
        .when(
            has_scheme & (F.length(good) < F.length(scheme)),
            F.concat(F.lit("Illegal character in scheme name at index "), F.length(good).cast("string"), F.lit(": "), uri),
        )
        .when(
            has_scheme & (F.length(scheme) + 1 == F.length(uri)),
            F.concat(F.lit("Expected scheme-specific part at index "), F.length(uri).cast("string"), F.lit(": "), uri),
        )
    )


def uri_output_dir(uri: Column, directory: str | None) -> Column:
    """Put the URI below ``directory`` with exactly the slashes needed between them."""
    if not directory:
        return uri
    if directory.endswith("/"):
        return F.when(uri.startswith("/"), F.concat(F.lit(directory), F.substr(uri, F.lit(2)))).otherwise(
            F.concat(F.lit(directory), uri)
        )
    return F.when(uri.startswith("/"), F.concat(F.lit(directory), uri)).otherwise(
        F.concat(F.lit(directory + "/"), uri)
    )


def uri_build(
    raw: Column,
    replace: list[tuple[str, str]] | str | None = None,
    prefix: str | None = None,
    suffix: str | None = None,
    encode: bool = True,
) -> tuple[Column, Column]:
    """(uri, skip reason) for a raw key: replace, then encode, then prefix and suffix."""
    replaced = uri_replace(raw, replace)
    error = uri_encode_error(replaced) if encode else F.lit(None).cast("string")
    body = uri_encode(replaced) if encode else replaced
    empty = raw.isNull() | (raw == "")
    reason = F.when(empty, F.lit("empty uri value")).otherwise(error)
    uri = F.when(reason.isNull(), uri_prefix_suffix(body, prefix, suffix))
    return uri, reason


def uri_generate(file: Column, block_start: Column, n: Column) -> Column:
    """``path-splitStart-n``: the n-th record of the split of ``file`` that starts at ``block_start``."""
    return F.concat(file_path_of(file), F.lit("-"), block_start.cast("string"), F.lit("-"), n.cast("string"))


def file_path_of(file: Column) -> Column:
    """Path portion of a file URI as Spark reports it."""
    return F.regexp_replace(file, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?", "")


def path_from_uri(uri: Column) -> Column:
    """Hierarchical URI: its decoded path. Opaque: its scheme-specific part. Unparsable: unchanged."""
    opaque = uri.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:[^/]")
    part = F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.\-]*:([^#]*)", 1)
    relative = ~uri.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:")
    legal = uri.rlike(r"^(?:[A-Za-z0-9_\-!.~'()*,;:$&+=@/?#\[\]]|%[0-9A-Fa-f]{2}|[^\x00-\x7F\p{Cc}\p{Z}])*$")
    path = F.when(relative, F.regexp_extract(uri, r"^(?://[^/?#]*)?([^?#]*)", 1)).otherwise(
        F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?([^?#]*)", 1)
    )

    def decoded(c: Column) -> Column:
        # url_decode also turns + into a space, which a path keeps
        return F.when(c.contains("%"), F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))).otherwise(c)

    return F.when(~legal, uri).when(opaque, decoded(part)).otherwise(decoded(path))


def strip_bom(header: Column) -> Column:
    return F.regexp_replace(header, "^\ufeff", "")


def filename_of(file: Column) -> Column:
    return F.regexp_extract(file, r"([^/]*)$", 1)


def directory_prefix(directory: str) -> str:
    return directory if directory.endswith("/") else directory + "/"


def whole_match(pattern: str) -> str:
    """A pattern that must match the whole name."""
    return f"^(?:{pattern})$"
