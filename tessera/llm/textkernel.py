"""Vectorised word scanning over Arrow text columns.

Words are maximal runs of "word" bytes of the UTF-8 text. All word classes of
this package are ASCII-delimited, so a byte table decides them exactly. A
word's 64-bit hash is a polynomial over its bytes, taken from one running sum
per segment (wrapping arithmetic, odd base, so powers can be inverted), then
mixed. Texts are handled in segments of about ``SEGMENT_BYTES``; a longer
single text forms a segment of its own and is never cut.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from ..session import ship_package

SEGMENT_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_POW: dict[str, np.ndarray] = {}
U64 = np.uint64


def _constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit constants from the splitmix64 sequence of ``seed``."""
    out = []
    x = seed & _MASK
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) & _MASK
        z = x
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        out.append((z ^ (z >> 31)) | 1)
    return np.array(out, dtype=U64)


GRAM = _constants(11, 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if "p" not in _POW or len(_POW["p"]) < n:
        size = max(n, SEGMENT_BYTES + 1)
        p = np.full(size, _BASE, dtype=U64)
        q = np.full(size, pow(_BASE, -1, 1 << 64), dtype=U64)
        p[0] = q[0] = 1
        p, q = np.cumprod(p, dtype=U64), np.cumprod(q, dtype=U64)
        if size > 4 * SEGMENT_BYTES:
            return p, q  # an oversized text: not kept
        _POW["p"], _POW["q"] = p, q
    return _POW["p"], _POW["q"]


def byte_table(is_delimiter, lower: bool = True, seed: int = 5) -> np.ndarray:
    """uint64[256]: 0 for delimiters, else the byte's constant (A-Z as a-z)."""
    vals = _constants(seed, 256)
    out = np.zeros(256, dtype=U64)
    for b in range(256):
        c = b + 32 if lower and 65 <= b <= 90 else b
        if not is_delimiter(c):
            out[b] = vals[c]
    return out


#: words are runs of anything but ASCII white space
SPACED = byte_table(lambda b: b == 32 or 9 <= b <= 13)
#: words are runs of ASCII letters, digits and non-ASCII characters
ALNUM = byte_table(lambda b: b < 48 or 58 <= b <= 96 or 123 <= b <= 127)
#: words are runs of ASCII letters and non-ASCII characters
LETTERS = byte_table(lambda b: b < 97 or 123 <= b <= 127)


def _two_byte_lower() -> np.ndarray:
    """Lower case of the characters U+0080 to U+07FF where it has two bytes too."""
    out = np.arange(0x800)
    for c in range(0x80, 0x800):
        low = chr(c).lower()
        if len(low) == 1 and 0x80 <= ord(low) < 0x800:
            out[c] = ord(low)
    return out


_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
_WIDE_LOWER = _two_byte_lower()


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with ASCII letters and two-byte characters in lower case; no
    character changes its length."""
    out = _ASCII_LOWER[data]
    at = np.flatnonzero((data >= 0xC2) & (data <= 0xDF))
    at = at[at + 1 < len(data)]
    if len(at):
        low = _WIDE_LOWER[((data[at].astype(np.int64) & 0x1F) << 6) | (data[at + 1] & 0x3F)]
        out[at] = 0xC0 | (low >> 6)
        out[at + 1] = 0x80 | (low & 0x3F)
    return out


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as the empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    _, off, data = arr.buffers()
    if len(arr) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def segments(offs: np.ndarray, limit: int = SEGMENT_BYTES):
    """Document ranges [i, j) of about ``limit`` bytes, at least one document."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


class Words:
    """Words of a segment: byte bounds, hashes, and each document's range."""

    __slots__ = ("data", "raw", "start", "end", "hash", "bounds")

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray, fold: bool = False):
        n = len(data)
        self.raw = data
        self.data = data = lowered(data) if fold else data
        v = table[data]
        inside = v != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cut = offs[:-1][offs[:-1] < n]
        first[cut] = inside[cut]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = offs[1:][offs[1:] > 0] - 1
        last[cut] = inside[cut]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, offs)
        p, q = powers(n)
        run = v * p[:n]
        np.cumsum(run, out=run)
        before = np.where(self.start > 0, run[self.start - 1], U64(0)) if n else run
        self.hash = mix64((run[self.end - 1] - before) * q[self.start])

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words (positions crossing documents included)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    s = h[:n] * GRAM[0]
    for i in range(1, k):
        s += h[i:n + i] * GRAM[i]
    s += U64(k)
    return mix64(s)


def scan(arr: pa.Array, table: np.ndarray, fold: bool = False):
    """Yield (first document, Words) for each segment of the column; ``fold`` lower-cases
    beyond ASCII (``Words.raw`` then has the text as it was)."""
    data, offs = text_buffers(arr)
    for i, j in segments(offs):
        yield i, Words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], table, fold)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the rows [bounds[i], bounds[i + 1]) for each i, each added up by itself
    (differences of one running sum would lose digits)."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]))
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(values, bounds[some], axis=0)
    return out


def list_array(parts: list[np.ndarray], typ: pa.DataType) -> pa.Array:
    """A list column from one numpy array per row."""
    lens = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    offs = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat, typ))


#: caches of this worker that outlive a task, by the operator that they belong to
_KEPT: dict[str, dict] = {}


def keep(owner: str, cache: dict):
    """Have ``cache`` emptied when this worker's next task is not one of ``owner``."""
    _KEPT[owner] = cache


def drop_kept(owner: str | None = None):
    """Empty the caches that other operators left in this worker."""
    held = [c for o, c in _KEPT.items() if o != owner and c]
    for cache in held:
        cache.clear()
    if held:
        free_memory()


def tidy(run, owner: str | None = None):
    """A batch function that gives its memory back to the system when its task
    ends: Python workers stay alive between tasks and stages. What other operators than
    ``owner`` keep there goes before it begins. Makes sure that the workers can
    import this package (before the plan that names the function is made)."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)

    def inner(batches):
        drop_kept(owner)
        yield from run(batches)
        free_memory()
    return inner


def free_memory():
    """Give unused memory of this worker back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(ctypes.util.find_library("c"))
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)
