"""A verified download: asked for only if changed, staged, checked, then moved into place."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable
from pathlib import Path

from foliospark.sources.web import Client, validators


def fetch(client: Client, url: str, path: Path, known: dict[str, str], verify: Callable[[Path], list[str]]) -> tuple[str, dict[str, str]]:
    """('unchanged' | 'stored', validators) for one file; what verification finds wrong is raised and the old file stays.

    ``known`` has the last answer's etag, last_modified and size. Where the
    server gives neither, an equal size counts as unchanged.
    """
    status, head, _ = client.fetch(url, validators(known.get("etag"), known.get("last_modified")) if path.exists() else None, "HEAD")
    size = head.get("content-length", "")
    marks = {"etag": head.get("etag", ""), "last_modified": head.get("last-modified", ""), "size": size}
    plain = not (marks["etag"] or marks["last_modified"])
    same_tag = bool(marks["etag"]) and marks["etag"] == known.get("etag")
    if path.exists() and (status == 304 or same_tag or (plain and size == str(path.stat().st_size))):
        return "unchanged", known
    _, _, body = client.fetch(url)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=path.name, suffix=".staged")
    staged = Path(name)
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(body or b"")
        if problems := verify(staged):
            raise ValueError(f"{url}: {'; '.join(problems)}")
        staged.replace(path)
    finally:
        staged.unlink(missing_ok=True)
    return "stored", marks
