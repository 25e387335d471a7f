"""Landed tables and files as batch or streaming frames."""

from wireglass.sources.landed import (  # noqa: F401
    RAW_REQUESTS,
    RESPONSES,
    RESPONSES_JSON,
    VIEW_REQUESTS,
    WS_FRAMES,
    read_blobs,
    read_fence_lines,
    read_landed,
    stream_landed,
    write_frame,
)
