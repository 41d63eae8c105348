"""Reader options (case-insensitive keys, string values like Spark's)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Option names and defaults of the feed reader.
ENABLE_LOOKUPS = "enableLookups"
MAX_CHARS_PER_COLUMN = "maxCharsPerColumn"
FILE_ENCODING = "fileEncoding"
DATA_ENCODING = "dataEncoding"
METADATA_PREFIX = "metadataPrefix"
METADATA_PREFIX_LEGACY = "METADATA_PREFIX"
PATH_GLOB_FILTER = "pathGlobFilter"
MODIFIED_BEFORE = "modifiedBefore"
MODIFIED_AFTER = "modifiedAfter"
TIME_ZONE = "timeZone"
MODE = "mode"
COMMENT = "comment"
JOIN_CONTINUATION_LINES = "joinContinuationLines"
BROADCAST_LIMIT_BYTES = "broadcastLimitBytes"
MAX_FILES_PER_SCAN = "maxFilesPerScan"
FILESETS = "filesets"
LOOKUP_MAX_CHARS = "lookupMaxCharsPerColumn"
LOOKUP_MAX_COLUMNS = "lookupMaxColumns"

DEFAULT_FILE_ENCODING = "ISO-8859-1"
DEFAULT_DATA_ENCODING = "UTF-8"
DEFAULT_METADATA_PREFIX = "_tech_"
DEFAULT_BROADCAST_LIMIT = 256 * 1024 * 1024
DEFAULT_MAX_FILES_PER_SCAN = 200_000

FILE_FILTER_OPTIONS = (PATH_GLOB_FILTER, MODIFIED_BEFORE, MODIFIED_AFTER, TIME_ZONE)


def _bool(name: str, value: str) -> bool:
    v = str(value).strip().lower()
    if v not in ("true", "false"):
        raise ValueError(f"option {name} must be 'true' or 'false', got {value!r}")
    return v == "true"


def _int(name: str, value: str) -> int:
    try:
        return int(str(value).strip())
    except ValueError:
        raise ValueError(f"option {name} must be an integer, got {value!r}") from None


@dataclass
class FeedOptions:
    raw: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.raw = {str(k).lower(): str(v) for k, v in self.raw.items()}
        self.enable_lookups = _bool(ENABLE_LOOKUPS, self.get(ENABLE_LOOKUPS, "true"))
        self.max_chars_per_column = _int(MAX_CHARS_PER_COLUMN, self.get(MAX_CHARS_PER_COLUMN, "-1"))
        self.lookup_limits = (
            _int(LOOKUP_MAX_CHARS, self.get(LOOKUP_MAX_CHARS, "-1")), _int(LOOKUP_MAX_COLUMNS, self.get(LOOKUP_MAX_COLUMNS, "-1"))
        )
        self.file_encoding = self.get(FILE_ENCODING, DEFAULT_FILE_ENCODING)
        self.data_encoding = self.get(DATA_ENCODING, DEFAULT_DATA_ENCODING)
        self.metadata_prefix = self.get(
            METADATA_PREFIX, self.get(METADATA_PREFIX_LEGACY, DEFAULT_METADATA_PREFIX)
        )
        mode = self.get(MODE, "PERMISSIVE").upper()
        if mode not in ("PERMISSIVE", "FAILFAST"):
            raise ValueError(f"option mode must be PERMISSIVE or FAILFAST, got {mode!r}")
        self.failfast = mode == "FAILFAST"
        self.comment = self.get(COMMENT, "#") or None
        self.join_continuation_lines = _bool(
            JOIN_CONTINUATION_LINES, self.get(JOIN_CONTINUATION_LINES, "true")
        )
        self.broadcast_limit = _int(
            BROADCAST_LIMIT_BYTES, self.get(BROADCAST_LIMIT_BYTES, str(DEFAULT_BROADCAST_LIMIT))
        )
        self.max_files_per_scan = _int(
            MAX_FILES_PER_SCAN, self.get(MAX_FILES_PER_SCAN, str(DEFAULT_MAX_FILES_PER_SCAN))
        )

        filesets = self.get(FILESETS)
        self.filesets = None if filesets is None else [x.strip() for x in filesets.split(",")]

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.raw.get(key.lower(), default)

    def file_filters(self) -> dict[str, str]:
        """Generic file-source options, applied to the manifest listing."""
        return {k: self.get(k) for k in FILE_FILTER_OPTIONS if self.get(k) is not None}
