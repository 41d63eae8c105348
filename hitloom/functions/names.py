"""File-name rules: fileset names of lookup archives, hit files and manifests,
and path helpers shared by the scan and the manifest toolkit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name conventions of a feed delivery.
LOOKUP_SUFFIX = "-lookup_data.tar.gz"
HIT_SUFFIX = ".tsv.gz"
MANIFEST_SUFFIX = ".txt"


# Scheme and authority of a path.
_ROOT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*:)(//[^/]*)?)?"


# A name that is empty, absolute or has a scheme, a spare slash, or a step "." or "..".
_NOT_PLAIN = r"^$|^/|:|//|/$|(?:^|/)\.{1,2}(?:/|$)"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, r"/+[^/]*/*$", "")


def lookup_fileset(path: Column) -> Column:
    """``<fileset>-lookup_data.tar.gz`` -> ``<fileset>``."""
    return F.replace(base_name(path), F.lit(LOOKUP_SUFFIX), F.lit(""))


def hit_fileset(path: Column) -> Column:
    """``01-<fileset>.tsv.gz`` -> ``<fileset>``: drop through the first ``-``."""
    name = base_name(path)
    return F.replace(F.substr(name, F.instr(name, "-") + 1), F.lit(HIT_SUFFIX), F.lit(""))


def reconstruct_key(path: Column) -> Column:
    """Key that pairs a hit file with its lookup archive when rebuilding lost
    manifests: only a leading ``NN-`` part number is stripped."""
    return F.replace(F.regexp_replace(base_name(path), r"^[0-9]+-", ""), F.lit(HIT_SUFFIX), F.lit(""))


def manifest_fileset(first_lookup: Column, first_data: Column) -> Column:
    """First lookup archive decides; else the first hit file; else null."""
    return F.coalesce(lookup_fileset(first_lookup), hit_fileset(first_data))


def resolve(directory: Column, name: Column) -> Column:
    """Resolve a manifest entry against the manifest's directory, in the form
    in which file listings give paths: absolute names (``/x`` or ``scheme:...``)
    stay absolute, an empty authority (``file:///x``) is the directory's, and
    repeated slashes, ``.`` and ``..`` are resolved."""
    has_scheme = name.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    full = F.when(has_scheme | name.startswith("/"), name).otherwise(F.concat(directory, F.lit("/"), name))
    scheme = F.regexp_extract(full, _ROOT, 1)
    authority = F.regexp_extract(full, _ROOT, 2)
    home_scheme, home_authority = F.regexp_extract(directory, _ROOT, 1), F.regexp_extract(directory, _ROOT, 2)
    at_home = (scheme == "") | ((scheme == home_scheme) & authority.isin("", "//"))
    root = F.when(at_home, F.concat(home_scheme, home_authority)).otherwise(
        F.concat(scheme, F.when(authority == "//", F.lit("")).otherwise(authority))
    )
    steps = F.filter(F.split(F.regexp_replace(full, _ROOT, ""), "/"), lambda x: ~x.isin("", "."))
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
            F.concat(acc, F.array(x))
        ),
    )
    walked = F.concat(root, F.lit("/"), F.array_join(kept, "/"))
    # Most names are plain relative ones, which only follow the directory.
    return F.when(name.rlike(_NOT_PLAIN), walked).otherwise(F.concat(directory, F.lit("/"), name))


def scan_path_key(file_path: Column) -> Column:
    """``_metadata.file_path`` is URI-encoded; decode it to the plain form the
    binaryFile listing and the manifest use (a literal '+' stays '+')."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


_GLOB_CHARS = "\\*?[]{}"


def escape_glob(path: str) -> str:
    """Hadoop globbing would expand these characters in a literal path."""
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in path)
