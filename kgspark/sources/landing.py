"""The landing area: snapshots of sources, fetched by the driver, checked, versioned by configuration."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from .storage import files

MAX_DOWNLOAD, MAX_EXPANDED = 512 << 20, 256 << 20


class SourceError(RuntimeError):
    """A source that can't be fetched or is over its limits."""


#: Bytes of each unit of a size given as text.
UNITS = {"TB": 1 << 40, "GB": 1 << 30, "MB": 1 << 20, "KB": 1 << 10, "B": 1, "": 1}


def size_in_bytes(text: str | None, default: int = 10 << 20) -> int:
    """Bytes of a size such as ``50KB`` or ``1.5 GB``; a bare number is bytes, and ``default`` stands for what is no size."""
    found = re.fullmatch(r"\s*([+-]?(?:\d+\.?\d*|\.\d+))\s*([KMGT]?B|)\s*", text or "", re.IGNORECASE)
    if not found or (not found[2] and "." in found[1]):
        return default
    return int(float(found[1]) * UNITS[found[2].upper()])


def file_provider(config: dict) -> bytes:
    path = Path(config["path"])
    if not path.is_file():
        raise SourceError(f"no such file: {path}")
    return bounded(iter([path.read_bytes()]), config.get("max_bytes", MAX_DOWNLOAD))


def http_provider(config: dict, get: Callable[..., Iterator[bytes]] | None = None) -> bytes:
    """A GET by ``get(url, timeout)``, which yields chunks; by default urllib."""
    if get is None:
        from urllib.request import urlopen

        def get(url: str, timeout: float) -> Iterator[bytes]:
            with urlopen(url, timeout=timeout) as r:  # noqa: S310
                yield from iter(lambda: r.read(1 << 16), b"")

    return bounded(get(config["url"], max(1, config.get("timeout", 30))), config.get("max_bytes", MAX_DOWNLOAD))


def paged_provider(config: dict, fetch: Callable[[int, int], list]) -> bytes:
    """Pages by offset and limit until a short one; their items as one JSON array."""
    size, items = config.get("page_size", 100), []
    while True:
        page = fetch(len(items), size)
        items += page
        if len(page) < size:
            return json.dumps(items, ensure_ascii=False).encode()


PROVIDERS: dict[str, Callable] = {"file": file_provider, "http": http_provider, "paged": paged_provider}


def bounded(chunks: Iterator[bytes], limit: int) -> bytes:
    out = io.BytesIO()
    for c in chunks:
        if out.tell() + len(c) > limit:
            raise SourceError(f"more than {limit} bytes")
        out.write(c)
    return out.getvalue()


def expand(data: bytes, member: str | None = None, limit: int = MAX_EXPANDED) -> bytes:
    """The content of gzip data, or of the first member of a zip file that matches (``*.ext`` or a path's end)."""
    if data[:2] == b"\x1f\x8b":
        with gzip.open(io.BytesIO(data)) as f:
            return bounded(iter(lambda: f.read(1 << 16), b""), limit)
    if data[:4] == b"PK\x03\x04":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for info in z.infolist():
                if member is None or info.filename.endswith(member.lstrip("*") if member.startswith("*") else member):
                    with z.open(info) as f:
                        return bounded(iter(lambda: f.read(1 << 16), b""), limit)
        raise SourceError(f"no member {member}")
    return bounded(iter([data]), limit)


class Landing:
    """A folder of snapshots by (source, configuration); writes are atomic and verified by digest.

    ``root`` is a local folder, or one of any file system that Spark writes to (then with a session).
    """

    def __init__(self, root: str, ttl_s: float = 24 * 3600, clock: Callable[[], float] = time.time, spark=None):
        self.root, self.ttl, self.clock, self.files = str(root).rstrip("/"), ttl_s, clock, files(spark, str(root))

    def place(self, source: str, config: dict) -> str:
        key = hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:32]
        return f"{self.root}/source={source}/{key}"

    def put(self, source: str, config: dict, data: bytes) -> Path | str:
        """Data are named by their digest and the entry is replaced last, so a reader of the old entry keeps its data until the next ``clear``."""
        at, digest = self.place(source, config), hashlib.sha256(data).hexdigest()
        self.files.write(f"{at}/snapshot-{digest[:16]}", data)
        self.files.write(f"{at}/_META", json.dumps({"sha256": digest, "bytes": len(data), "at": self.clock()}))
        return self._path(at, digest)

    def _path(self, at: str, digest: str) -> Path | str:
        name = f"{at}/snapshot-{digest[:16]}"
        return name if "://" in name else Path(name)

    def get(self, source: str, config: dict, *, ignore_ttl: bool = False) -> Path | str | None:
        at = self.place(source, config)
        if not self.files.exists(f"{at}/_META"):
            return None
        meta = json.loads(self.files.read(f"{at}/_META"))
        path = self._path(at, meta["sha256"])
        if not ignore_ttl and self.clock() - meta["at"] > self.ttl or not self.files.exists(str(path)):
            return None
        return path if self.files.sha256(str(path)) == meta["sha256"] else None

    def fetch(self, source: str, kind: str, config: dict, *, skip_download: bool = False, member: str | None = None, **more) -> Path | str:
        """A fresh stored snapshot, else a new one; without downloads a stored one of any age, or an error."""
        found = self.get(source, config, ignore_ttl=skip_download)
        if found:
            return found
        if skip_download:
            raise SourceError(f"nothing stored for {source}")
        return self.put(source, config, expand(PROVIDERS[kind](config, **more), member or config.get("extract_file")))

    def _metas(self) -> list[dict]:
        return [json.loads(self.files.read(f"{self.root}/{s}/{k}/_META")) for s in self.files.names(self.root) if s.startswith("source=") for k in self.files.names(f"{self.root}/{s}") if self.files.exists(f"{self.root}/{s}/{k}/_META")]

    def stats(self) -> dict[str, int]:
        metas = self._metas()
        return {"entries": len(metas), "bytes": sum(m["bytes"] for m in metas), "expired": sum(self.clock() - m["at"] > self.ttl for m in metas)}

    def clear(self, source: str) -> int:
        found = self.files.names(f"{self.root}/source={source}")
        for name in found:
            self.files.delete(f"{self.root}/source={source}/{name}")
        return len(found)


def keep_newest(root: str, keep: int, spark=None) -> list[str]:
    """Remove all but the newest ``keep`` snapshot folders by name; folders with scratch or lock files stay."""
    disk = files(spark, str(root))
    folders = sorted((n for n in disk.names(str(root)) if disk.is_folder(f"{root}/{n}")), reverse=True)
    gone = [n for n in folders[keep:] if not any(x.endswith((".tmp", ".lock")) for x in disk.tree(f"{root}/{n}"))]
    for n in gone:
        disk.delete(f"{root}/{n}")
    return gone
