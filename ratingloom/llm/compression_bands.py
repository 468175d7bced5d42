"""Quality rules: compression bands.

Text that zstandard shrinks far more than prose of its length is repetitive, text that it hardly
shrinks is random. The ratio raw bytes / compressed bytes of the whole text is held against limits
for its length, and the ratios of fixed chunks against limits for a chunk, so that a long text
cannot hide a repetitive or random stretch behind good prose.

Null and empty texts have no words: all counts are 0, ``base_failed`` is true, ``kept`` false.
Repeated rows give repeated results; other columns of the table are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from ratingloom.llm.common import map_rows

WINDOW = 8
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
INNER_BYTES = bytes(range(0x80, 0xC0))  # second and later bytes of a code point


@dataclass(frozen=True)
class Limits:
    """Allowed ratios of a text (or chunk) of at least ``min_bytes`` bytes."""

    min_bytes: int
    lowest: float
    highest: float


# Short texts compress badly whatever they say, long prose finds more to repeat: each length has its band.
WHOLE_LIMITS = (
    Limits(0, 0.0, 6.0),
    Limits(256, 1.15, 3.0),
    Limits(1_024, 1.45, 3.2),
    Limits(4_096, 1.6, 3.6),
    Limits(16_384, 1.7, 4.2),
)
CHUNK_BYTES = 4_096
CHUNK_LIMITS = Limits(1_024, 1.45, 4.0)
BAD_CHUNK_SHARE = 0.3
LEVEL = 3

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_bytes long, ratio double, n_chunks long, n_bad_chunks long"
)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more, the first one included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
    if len(numbers) >= len(words) - 1 and width > 2:
        return 0  # a repeated window repeats each of its words
    with np.errstate(over="ignore"):
        mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        hashes = np.zeros(n, np.uint64)
        for k in range(width):
            hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = True
    maybe[order[:-1][same]] = True
    starts = np.flatnonzero(maybe)
    # equal hashes are only a hint: the windows themselves decide
    windows = ids[starts[:, None] + np.arange(width)]
    _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    starts = starts[counts[inverse.ravel()] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(cover[:-1])))


def _band(size: int, limits: tuple[Limits, ...]) -> Limits:
    chosen = limits[0]
    for band in limits:
        if size >= band.min_bytes:
            chosen = band
    return chosen


def judge_text(
    text: str | None,
    compressor: zstandard.ZstdCompressor,
    whole: tuple[Limits, ...] = WHOLE_LIMITS,
    chunk: Limits = CHUNK_LIMITS,
    chunk_bytes: int = CHUNK_BYTES,
    bad_share: float = BAD_CHUNK_SHARE,
) -> tuple:
    """All columns of SCHEMA for one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n_words = len(words)
    word_chars = len(raw.translate(None, SPACES + INNER_BYTES))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n_repeat = repeated_words(words)
    failed = n_words < 20 or 100 * n_repeat > 30 * n_words
    ratio = len(raw) / len(compressor.compress(raw)) if raw else 0.0
    n_chunks = n_bad = 0
    for start in range(0, len(raw), chunk_bytes):
        part = raw[start : start + chunk_bytes]
        if len(part) >= chunk.min_bytes:
            n_chunks += 1
            n_bad += not chunk.lowest <= len(part) / len(compressor.compress(part)) <= chunk.highest
    band = _band(len(raw), whole)
    kept = not failed and band.lowest <= ratio <= band.highest and n_bad <= bad_share * n_chunks
    return (
        n_words, word_chars, n_symbols, len(lines) - len(set(lines)), n_repeat, failed,
        kept, len(raw), float(ratio), n_chunks, n_bad,
    )


def compression_bands(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    whole: tuple[Limits, ...] = WHOLE_LIMITS,
    chunk: Limits = CHUNK_LIMITS,
    chunk_bytes: int = CHUNK_BYTES,
    bad_share: float = BAD_CHUNK_SHARE,
    level: int = LEVEL,
) -> DataFrame:
    """Columns ``keep``, the base counts and the verdict of every row; no shuffle."""

    def make():
        compressor = zstandard.ZstdCompressor(level=level, write_checksum=False)
        return lambda value: judge_text(value, compressor, whole, chunk, chunk_bytes, bad_share)

    return map_rows(docs, [text], make, SCHEMA, keep)
