"""The latent space of large vocabularies: a randomized singular value decomposition whose matrices no process holds whole.

A matrix of features x columns lies in the shared folder as files, a file for each SLAB of rows and each block of columns. X'X acts on
every column by itself, so a task multiplies one block of columns and reads all rows of X, which are packed for it. Columns are made
orthonormal by their Gram matrix, slab by slab. Either step replaces its files one by one, so the matrix is there once; if a task is
lost while it replaces them, the decomposition begins anew. Only matrices of columns x columns meet the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from ..scratch import folder

#: Rows of a slab, columns of a block at most, tasks of a step that returns a matrix of columns x columns.
SLAB, BLOCK, TASKS = 4096, 192, 12
#: Terms that at least one row in DENSE has are multiplied as a dense matrix, DENSE_TERMS of them at most.
DENSE, DENSE_TERMS = 30, 2048
#: Nonzeros and rows of a pack, and rows whose products with all columns are held at a time.
PACK, PACK_ROWS, ROWS = 500_000, 2048, 4096
#: Squared lengths of columns below this share of the largest are taken for it.
LEAST = 1e-13


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class Blocks:
    """rows x columns in float32 in a shared folder; `signs` multiplies the columns."""

    uri: str
    rows: int
    columns: int
    height: int = SLAB
    breadth: int = BLOCK
    step: int = 0
    signs: np.ndarray | None = None

    @property
    def slabs(self) -> list[tuple[int, int]]:
        return [(a, min(self.rows, a + self.height)) for a in range(0, self.rows, self.height)]

    @property
    def parts(self) -> list[tuple[int, int]]:
        e = np.linspace(0, self.columns, -(-self.columns // self.breadth) + 1).astype(int).tolist()
        return list(zip(e[:-1], e[1:]))

    def _name(self, base: str, slab: int, part: int) -> str:
        return f"{base}/{self.step}-{slab}-{part}"

    def write(self, slab: int, part: int, x: np.ndarray) -> None:
        """All of a file or nothing: a task that runs again finds what it wrote."""
        fs, base = _open(self.uri)
        to = self._name(base, slab, part)
        temporary = f"{to}.{np.random.default_rng().integers(1 << 62):x}"
        with fs.open_output_stream(temporary) as f:
            f.write(np.ascontiguousarray(x, np.float32))
        fs.move(temporary, to)

    def there(self, names: list[tuple[int, int]]) -> bool:
        fs, base = _open(self.uri)
        found = [x.type == pa.fs.FileType.File for x in fs.get_file_info([self._name(base, *n) for n in names])]
        if any(found) and not all(found):
            raise HalfReplacedError(self.uri)
        return all(found)

    def delete(self, slab: int, part: int) -> None:
        fs, base = _open(self.uri)
        try:
            fs.delete_file(self._name(base, slab, part))
        except FileNotFoundError:  # the random matrix is in no file
            pass

    def file(self, slab: int, part: int) -> np.ndarray:
        fs, base = _open(self.uri)
        a, b = self.parts[part]
        with fs.open_input_file(self._name(base, slab, part)) as f:
            x = np.frombuffer(f.read_buffer(), np.float32).reshape(-1, b - a)
        return x if self.signs is None else x * self.signs[a:b]

    def slab(self, slab: int) -> np.ndarray:
        return np.concatenate([self.file(slab, j) for j in range(len(self.parts))], axis=1)

    def part(self, part: int, rows: np.ndarray | None = None) -> np.ndarray:
        """A block of columns: all rows, or those of the given ascending numbers."""
        a, b = self.parts[part]
        out = np.empty((self.rows if rows is None else len(rows), b - a), np.float32)
        for i, (low, high) in enumerate(self.slabs):
            if rows is None:
                out[low:high] = self.file(i, part)
            else:
                p, q = np.searchsorted(rows, (low, high))
                if p < q:
                    out[p:q] = self.file(i, part)[rows[p:q] - low]
        return out

    def whole(self) -> np.ndarray:
        return np.concatenate([self.slab(i) for i in range(len(self.slabs))])


# ---------------------------------------------------------------- rows of X


def _planes(x: np.ndarray) -> bytes:
    """Integers byte by byte of their four, lowest first: high bytes are mostly zero."""
    return pa.compress(np.ascontiguousarray(x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unplaned(x: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(x, 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(raw.T).view(np.uint32).ravel()


PACKED, PACKED_NAMES = "lens binary, cols binary, tfs binary, n int, nnz int", ["lens", "cols", "tfs", "n", "nnz"]


def packs(d: np.ndarray, c: np.ndarray, tf: np.ndarray, n: int) -> Iterator[tuple[int, int, dict]]:
    """(from, to, columns of PACKED) for n rows whose entries (row, column, count) ascend by row and column."""
    ends = np.searchsorted(d, np.arange(n + 1))
    a = 0
    while a < n:
        b = min(n, a + PACK_ROWS, max(a + 1, int(np.searchsorted(ends, ends[a] + PACK, "right")) - 1))
        x, t = c[ends[a] : ends[b]], tf[ends[a] : ends[b]]
        # differences wrap around, and their sums do
        yield a, b, {"lens": _planes(np.diff(ends[a : b + 1])), "cols": _planes(np.diff(x, prepend=0)), "tfs": _planes(t), "n": b - a, "nnz": len(x)}
        a = b


def unpacked(row: dict, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, column, weight) of a pack, rows at unit length, and the number of its rows."""
    n = row["n"]
    d = np.repeat(np.arange(n), _unplaned(row["lens"], n))
    c = np.cumsum(_unplaned(row["cols"], row["nnz"]), dtype=np.uint32).astype(np.int64)
    return d, c, weights(d, c, _unplaned(row["tfs"], row["nnz"]), idf, n), n


def weights(d: np.ndarray, c: np.ndarray, tf: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    w = (1 + np.log(np.arange(1, tf.max(initial=0) + 1)))[tf - 1] * idf[c] if tf.max(initial=0) < 1 << 16 else (1 + np.log(tf)) * idf[c]
    return w / np.sqrt(np.bincount(d, w * w, n))[d]


def read_packs(uri: str) -> Iterator[dict]:
    fs, base = _open(uri)
    for x in sorted(fs.get_file_info(pa.fs.FileSelector(base)), key=lambda x: x.path):
        if x.path.endswith(".parquet"):
            with fs.open_input_file(x.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(4, columns=PACKED_NAMES):
                    yield from batch.to_pylist()


class HalfReplacedError(RuntimeError):
    """An attempt of a task finds that another one replaced some of its files and was lost."""


class Rows:
    """Rows of X: the columns below `dense` as a dense matrix, the others one by one."""

    def __init__(self, d: np.ndarray, c: np.ndarray, w: np.ndarray, n: int, dense: int):
        self.dense = dense
        often = c < dense
        self.x = np.zeros((n, dense), np.float32)
        self.x[d[often], c[often]] = w[often]
        d, self.c, self.w = d[~often], c[~often], w[~often].astype(np.float32)
        cuts = np.flatnonzero(np.diff(d, prepend=-1)).tolist()
        self.runs = list(zip(d[cuts].tolist(), cuts, [*cuts[1:], len(d)]))

    def times(self, q: np.ndarray) -> np.ndarray:
        """X q."""
        y = self.x @ q[: self.dense]
        c, w = self.c, self.w
        for i, a, b in self.runs:
            y[i] += w[a:b] @ q[c[a:b]]
        return y

    def back(self, y: np.ndarray, total: np.ndarray) -> None:
        """total += X' y."""
        total[: self.dense] += self.x.T @ y
        c, w = self.c, self.w[:, None]
        for i, a, b in self.runs:
            # a row names a column once
            total[c[a:b]] += w[a:b] * y[i]


def dense_terms(dfs: np.ndarray, n: int) -> int:
    """How many leading columns are multiplied as a dense matrix."""
    return min(DENSE_TERMS, int((dfs * DENSE >= n).sum()))


def products(d: np.ndarray, c: np.ndarray, w: np.ndarray, n: int, q: Blocks, dense: int) -> np.ndarray:
    """X q for some rows, block by block; only the rows of q that they need are read."""
    out = np.zeros((n, q.columns), np.float32)
    if len(d):
        used, at = np.unique(c, return_inverse=True)
        rows = Rows(d, at, w, n, int(np.searchsorted(used, dense)))
        for j, (a, b) in enumerate(q.parts):
            out[:, a:b] = rows.times(q.part(j, used))
    return out


def grouped(batches: Iterator[pa.RecordBatch], idf: np.ndarray, keep: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, list[pa.Array]]]:
    """Packs joined up to ROWS rows: (row, column, weight, rows, kept columns)."""
    held: list[tuple] = []

    def joined() -> tuple:
        starts = np.cumsum([0, *(x[3] for x in held)])
        d = np.concatenate([x[0] + s for x, s in zip(held, starts)])
        return d, np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]), int(starts[-1]), [pa.concat_arrays([x[4][k] for x in held]) for k in range(len(keep))]

    for batch in batches:
        for i in range(batch.num_rows):
            row = {x: batch.column(x)[i].as_py() for x in PACKED_NAMES}
            if held and (sum(x[3] for x in held) + row["n"] > ROWS or sum(len(x[0]) for x in held) + row["nnz"] > 4 * PACK):
                yield joined()
                held = []
            held.append((*unpacked(row, idf), [batch.column(k)[i].values for k in keep]))
    if held:
        yield joined()


# ---------------------------------------------------------------- steps


def _each(spark: SparkSession, n: int, run: Callable[[int], bytes | None], tasks: int | None = None) -> list[bytes]:
    """run(0) ... run(n - 1) in tasks; what they return."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([run(i) or b""], pa.binary())], ["v"])

    return spark.range(0, n, 1, tasks or n).mapInArrow(go, "v binary").toArrow().column("v").to_pylist()


def _symmetric(parts: list[bytes], k: int) -> np.ndarray:
    """The sum of upper triangles as a symmetric matrix."""
    total = np.zeros(k * (k + 1) // 2)
    for x in parts:
        if x:
            total += np.frombuffer(x)
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = total
    return out + np.triu(out, 1).T


def multiplied(spark: SparkSession, rows_uri: str, q: Blocks, idf: np.ndarray, dense: int, seed: int) -> Blocks:
    """X'X q in place of q; in the first step q is random."""
    to = replace(q, step=q.step + 1)

    def run(j: int) -> None:
        names = [(i, j) for i in range(len(q.slabs))]
        if to.there(names):
            return
        a, b = q.parts[j]
        x = np.random.default_rng((seed, j)).standard_normal((q.rows, b - a), np.float32) if q.step == 0 else q.part(j)
        total = np.zeros_like(x)
        for row in read_packs(rows_uri):
            if row["nnz"]:
                rows = Rows(*unpacked(row, idf), dense)
                rows.back(rows.times(x), total)
        for i, (low, high) in enumerate(q.slabs):
            q.delete(i, j)
            to.write(i, j, total[low:high])

    _each(spark, len(q.parts), run)
    return to


def gram(spark: SparkSession, q: Blocks) -> np.ndarray:
    """q'q."""
    tasks = min(TASKS, len(q.slabs))

    def run(t: int) -> bytes:
        total = np.zeros((q.columns, q.columns))
        for i in range(t, len(q.slabs), tasks):
            x = q.slab(i).astype(float)
            total += x.T @ x
        return total[np.triu_indices(q.columns)].tobytes()

    return _symmetric(_each(spark, tasks, run), q.columns)


def mixed(spark: SparkSession, q: Blocks, t: np.ndarray) -> Blocks:
    """q t in place of q, slab by slab."""
    to = replace(q, step=q.step + 1, columns=t.shape[1])
    fs, base = _open(q.uri)
    # in a file rather than a closure, of which every executor keeps a copy on its disk
    with fs.open_output_stream(f"{base}/{q.step}-t") as f:
        f.write(np.ascontiguousarray(t, np.float32))

    def run(i: int) -> None:
        names = [(i, j) for j in range(len(to.parts))]
        if not to.there(names):
            fs, base = _open(q.uri)
            with fs.open_input_file(f"{base}/{q.step}-t") as f:
                x = q.slab(i) @ np.frombuffer(f.read_buffer(), np.float32).reshape(q.columns, to.columns)
            for j in range(len(q.parts)):
                q.delete(i, j)
                if j < len(to.parts):
                    to.write(i, j, x[:, slice(*to.parts[j])])

    _each(spark, len(q.slabs), run, min(TASKS, len(q.slabs)))
    fs.delete_file(f"{base}/{q.step}-t")
    return to


def orthonormal(spark: SparkSession, q: Blocks) -> Blocks:
    s, u = np.linalg.eigh(gram(spark, q))
    # columns too short for the Gram matrix keep their share of the space and are told apart in the next step
    return mixed(spark, q, u / np.sqrt(np.maximum(s, max(s[-1] * LEAST, 1e-300))))


def ritz(rows: DataFrame, q: Blocks, idf: np.ndarray, dense: int) -> np.ndarray:
    """(X q)' (X q)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((q.columns, q.columns))
        for d, c, w, n, _ in grouped(batches, idf, []):
            y = products(d, c, w, n, q, dense)
            for a in range(0, n, 2048):
                part = y[a : a + 2048].astype(float)
                total += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array([total[np.triu_indices(q.columns)].tobytes()], pa.binary())], ["v"])

    return _symmetric(rows.coalesce(TASKS).mapInArrow(run, "v binary").toArrow().column("v").to_pylist(), q.columns)


def signed(spark: SparkSession, q: Blocks) -> Blocks:
    """The largest entry of a column is positive, so that the sign is the same in every run."""

    def run(i: int) -> bytes:
        x = q.slab(i)
        return x[np.abs(x).argmax(0), np.arange(q.columns)].tobytes()

    most = np.array([np.frombuffer(x, np.float32) for x in _each(spark, len(q.slabs), run, min(TASKS, len(q.slabs)))])
    return replace(q, signs=np.where(most[np.abs(most).argmax(0), np.arange(q.columns)] < 0, -1, 1).astype(np.float32))


def decompose(spark: SparkSession, rows: DataFrame, rows_uri: str, idf: np.ndarray, dense: int, k: int, width: int, powers: int, seed: int) -> Blocks:
    """The first k right singular vectors of X, as columns. Those of no singular value are zero."""
    for left in (2, 1, 0):
        try:
            return _decompose(spark, folder(spark), rows, rows_uri, idf, dense, k, width, powers, seed)
        except Exception as e:
            if not left or HalfReplacedError.__name__ not in str(e):
                raise
    raise AssertionError("not reached")


def _decompose(spark: SparkSession, uri: str, rows: DataFrame, rows_uri: str, idf: np.ndarray, dense: int, k: int, width: int, powers: int, seed: int) -> Blocks:
    q = Blocks(uri, len(idf), width, SLAB, BLOCK)
    for _ in range(powers):
        q = orthonormal(spark, multiplied(spark, rows_uri, q, idf, dense, seed))
    # the basis may lack columns, so its own Gram matrix counts
    s, u = np.linalg.eigh(gram(spark, q))
    t = u[:, s > 1e-6 * s[-1]] / np.sqrt(s[s > 1e-6 * s[-1]])
    values, vectors = np.linalg.eigh(t.T @ ritz(rows, q, idf, dense) @ t)
    found = (t @ vectors[:, ::-1])[:, :k]
    return signed(spark, mixed(spark, q, np.pad(found, ((0, 0), (0, k - found.shape[1])))))
