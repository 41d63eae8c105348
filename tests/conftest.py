from __future__ import annotations

import gzip
import io
import os
import sys
import tarfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hitloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=8)


def write_archive(path: str, entries: dict[str, bytes | str]) -> None:
    with tarfile.open(path, "w:gz") as tf:
        for name, data in entries.items():
            raw = data.encode("utf-8") if isinstance(data, str) else data
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            tf.addfile(info, io.BytesIO(raw))


def write_gz(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wb") as f:
        f.write(text.encode("utf-8"))


def write_manifest(path: str, lookups: list[str], datas: list[str], comment: str | None = None) -> None:
    parts = []
    if comment:
        parts.append(comment)
    parts.append(
        f"Datafeed-Manifest-Version: 1.0\nLookup-Files: {len(lookups)}\nData-Files: {len(datas)}\nTotal-Records: 0"
    )
    for lk in lookups:
        parts.append(f"Lookup-File: {lk}\nMD5-Digest: 0\nFile-Size: 1")
    for d in datas:
        parts.append(f"Data-File: {d}\nMD5-Digest: 0\nFile-Size: 1\nRecord-Count: 1")
    with open(path, "w") as f:
        f.write("\n\n".join(parts))


def make_feed(
    root: str,
    fileset: str,
    headers: list[str],
    hit_text: str,
    lookups: dict[str, str] | None = None,
    n_files: int = 1,
    extra_text: list[str] | None = None,
) -> None:
    """A feed directory with one manifest, one archive and ``n_files`` hit files."""
    os.makedirs(root, exist_ok=True)
    entries = {"column_headers.tsv": "\t".join(headers) + "\n"}
    entries.update(lookups or {})
    write_archive(f"{root}/{fileset}-lookup_data.tar.gz", entries)
    datas = []
    texts = [hit_text] + list(extra_text or [])
    for i in range(n_files):
        name = f"{i + 1:02d}-{fileset}.tsv.gz"
        write_gz(f"{root}/{name}", texts[i] if i < len(texts) else "")
        datas.append(name)
    write_manifest(f"{root}/{fileset}.txt", [f"{fileset}-lookup_data.tar.gz"], datas)
