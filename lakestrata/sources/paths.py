"""Storage roots from settings."""

from __future__ import annotations

from collections.abc import Mapping

# The storage kinds and setting names existing settings tables use.
KIND_KEY = "TipoStorage"
VOLUME_KIND, VOLUME_KEYS = "Volume", ("catalogoVolume", "esquemaVolume", "nombreVolume")
BUCKET_KIND, BUCKET_KEY = "AmazonS3", "bucketS3"


def root_keys(kind: str | None) -> tuple[str, ...]:
    """The settings a storage kind needs for its root; none for an unknown kind."""
    return {VOLUME_KIND: VOLUME_KEYS, BUCKET_KIND: (BUCKET_KEY,)}.get(kind, ())


def resolve_path(settings: Mapping[str, str], relative: str) -> str:
    """The absolute URI of ``relative``; raises ValueError on an unknown storage kind."""
    kind = settings.get(KIND_KEY)
    if kind == VOLUME_KIND:
        parts = ["/Volumes", *(_required(settings, key) for key in VOLUME_KEYS)]
    elif kind == BUCKET_KIND:
        parts = [f"s3://{_required(settings, BUCKET_KEY)}"]
    else:
        raise ValueError(f"unknown storage kind {kind!r}: expected {VOLUME_KIND} or {BUCKET_KIND}")
    return "/".join([*parts, relative.lstrip("/")])


def _required(settings: Mapping[str, str], key: str) -> str:
    if not settings.get(key):
        raise ValueError(f"setting {key} is missing")
    return settings[key]
