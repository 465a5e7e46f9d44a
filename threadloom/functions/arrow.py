"""Per-word mapping of token arrays inside Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def map_words(words: pa.Array, change: Callable[[str], str]) -> pa.Array:
    """Apply ``change`` to every token of a list array.

    The batch is dictionary-encoded first, so a word is changed once per batch
    however often it occurs.
    """
    encoded = words.flatten().dictionary_encode()
    changed = pa.array([change(w) for w in encoded.dictionary.to_pylist()], pa.string())
    lengths = pc.fill_null(pc.list_value_length(words), 0)
    offsets = pa.concat_arrays(
        [pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())]
    )
    return pa.ListArray.from_arrays(
        offsets, changed.take(encoded.indices), mask=words.is_null()
    )


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)), pa.int32())


def count_words(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The different words of every row in the order of their bytes, and how often each occurs, in two list arrays."""
    encoded = words.flatten().dictionary_encode()
    size = max(len(encoded.dictionary), 1)
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(words)), lengths)
    pairs, counts = np.unique(row * size + place[encoded.indices.to_numpy()], return_counts=True)
    ends = _offsets(np.bincount(pairs // size, minlength=len(words)))
    terms = encoded.dictionary.take(pa.array(order[pairs % size]))
    return pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))


def invert(posts: pa.RecordBatch) -> pa.RecordBatch:
    """Postings (term, block, n, max_tf, min_length and lists of key, tf and length) of posts with key, block, length, terms and counts."""
    terms = posts.column("terms")
    encoded = terms.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
    size = max(len(encoded.dictionary), 1)
    blocks, block = np.unique(posts.column("block").to_numpy(), return_inverse=True)
    pair = block[row] * size + encoded.indices.to_numpy()
    order = np.argsort(pair, kind="stable")
    pair, row = pair[order], row[order]
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(pair)))
    tf = posts.column("counts").flatten().to_numpy()[order]
    length = posts.column("length").to_numpy()[row]
    ends = _offsets(sizes)
    made = {
        "term": encoded.dictionary.take(pa.array(pair[first] % size)),
        "block": pa.array(blocks[pair[first] // size], pa.int64()),
        "n": pa.array(sizes, pa.int64()),
        "max_tf": pa.array(np.maximum.reduceat(tf, first) if len(first) else tf, pa.int32()),
        "min_length": pa.array(np.minimum.reduceat(length, first) if len(first) else length, pa.int32()),
        "key": pa.ListArray.from_arrays(ends, posts.column("key").take(pa.array(row))),
        "tf": pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
        "length": pa.ListArray.from_arrays(ends, pa.array(length, pa.int32())),
    }
    return pa.RecordBatch.from_pydict(made)
