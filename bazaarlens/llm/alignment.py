"""Alignment of two tokenizers' tokens by the bytes they cover.

A batch's tokens are two frames of (document, start, end). `pandas.merge_asof`, keyed by document, gives
each token start the other side's token that covers it; both directions together are all overlaps. Where an
overlap's two tokens end together, a group ends, and the two are linked.

How often two ids are linked in the whole corpus takes a second step. Documents are stored with their links as numbers
into a list of the distinct pairs of their chunk, some megabytes of text. So a pair is one row per
chunk, however frequent it is: pairs are counted over all chunks, their totals go back to the chunks, and the
documents of a chunk meet its totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.tokens import byte_tokenizer, tokenizer
from bazaarlens.session import materialize, release

# Characters that are aligned at a time, and links that share a list of pairs, about; a document is never cut.
CHARS_AT_ONCE = 1 << 20
LINKS_OF_A_CHUNK = 1 << 22

_STORED = (
    "chunk long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links binary, pairs array<long>, times array<int>"
)


class _Side:
    """One tokenizer's ids as bytes, and as decimal numbers."""

    def __init__(self, model):
        self.model = model
        self.bytes = pa.array(model.token_bytes(), pa.binary())
        # Each number behind a comma, in a row of one width.
        written = [b",%d" % i for i in range(len(self.bytes))]
        self.sizes = np.array([len(w) for w in written])
        self.written = np.array(written, dtype=f"S{self.sizes.max()}").view(np.uint8).reshape(len(written), -1)

    def tokens(self, texts: list[str], wanted: list[bytes]) -> pd.DataFrame:
        """doc, id, start and end of the tokens of the texts; none where their bytes are not those wanted.

        Places are counted through all texts.
        """
        ids = self.model.encoded(texts)
        counts = np.array([len(i) for i in ids])
        doc = np.repeat(np.arange(len(texts)), counts)
        flat = np.fromiter((i for one in ids for i in one), dtype=np.int64, count=counts.sum())
        joined = self.bytes.take(pa.array(flat))
        offsets = np.frombuffer(joined.buffers()[1], dtype=np.int32)[: len(flat) + 1].astype(np.int64)
        data = joined.buffers()[2].to_pybytes() if len(flat) else b""
        edges = offsets[np.concatenate([[0], np.cumsum(counts)])]
        same = np.array([data[a:b] == w for a, b, w in zip(edges[:-1], edges[1:], wanted)], dtype=bool)
        # Starts go on where the wanted bytes do, so both sides agree about them.
        shift = np.concatenate([[0], np.cumsum([len(w) for w in wanted])[:-1]]) - edges[:-1]
        frame = pd.DataFrame({"doc": doc, "id": flat, "start": offsets[:-1] + shift[doc], "end": offsets[1:] + shift[doc]})
        return frame, same


@lru_cache(maxsize=1)
def _sides(a_file: str, b_file: str) -> tuple[_Side, _Side]:
    return _Side(byte_tokenizer(a_file)), _Side(tokenizer(b_file))


def _overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """(a, b), by their places in the frames, of all tokens that share bytes."""
    a = pd.DataFrame({"doc": a["doc"], "start": a["start"], "a": np.arange(len(a))})
    b = pd.DataFrame({"doc": b["doc"], "start": b["start"], "b": np.arange(len(b))})
    covering = [pd.merge_asof(a, b, on="start", by="doc"), pd.merge_asof(b, a, on="start", by="doc")]
    both = pd.concat([frame[["a", "b"]] for frame in covering]).astype(np.int64)
    # A pair that starts together was found from both sides.
    begun_together = a["start"].to_numpy()[both["a"]] == b["start"].to_numpy()[both["b"]]
    begun_together[: len(a)] = False
    return both[~begun_together]


def _aligned(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The places of the linked tokens on both sides, in order: each link ends a group."""
    overlaps = _overlaps(a, b)
    at_a, at_b = overlaps["a"].to_numpy(), overlaps["b"].to_numpy()
    ends = a["end"].to_numpy()[at_a] == b["end"].to_numpy()[at_b]
    at_a, at_b = at_a[ends], at_b[ends]
    order = np.argsort(at_a, kind="stable")
    return at_a[order], at_b[order]


def _written_groups(sides: tuple[_Side, _Side], a: pd.DataFrame, b: pd.DataFrame, link_a: np.ndarray, link_b: np.ndarray):
    """The groups of all documents as bytes, `a1,a2|b1;a3|b2,b3;...`, and where each token's number begins in them."""
    # Groups in order: the A tokens of one, then its B tokens.
    group_a = np.searchsorted(link_a, np.arange(len(a)))
    group_b = np.searchsorted(link_b, np.arange(len(b)))
    place_a = np.arange(len(a)) + np.concatenate([[0], link_b + 1])[group_a]
    place_b = np.arange(len(b)) + link_a[group_b] + 1 if len(b) else group_b
    total = len(a) + len(b)
    width = max(side.written.shape[1] for side in sides)
    table = np.zeros((total, width), dtype=np.uint8)
    sizes = np.zeros(total, dtype=np.int64)
    for side, frame, place, mark in ((sides[0], a, place_a, b";"), (sides[1], b, place_b, b"|")):
        ids = frame["id"].to_numpy()
        table[place, : side.written.shape[1]] = side.written[ids]
        sizes[place] = side.sizes[ids]
        group = group_a if mark == b";" else group_b
        first = np.ones(len(place), dtype=bool)
        first[1:] = group[1:] != group[:-1]
        table[place[first], 0] = mark[0]
    text = table[np.arange(width) < sizes[:, None]]
    return text, np.concatenate([[0], np.cumsum(sizes)]), place_a


def _documents(sides: tuple[_Side, _Side], texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """(n_a, n_b, n_groups, digest) of each text, the id pairs of all links, and how many each text has."""
    wanted = [b" " + text.encode() if text else b"" for text in texts]
    spaced = [" " + text if text else "" for text in texts]
    (a, same_a), (b, same_b) = sides[0].tokens(spaced, wanted), sides[1].tokens([text or "" for text in texts], wanted)
    good = same_a & same_b
    a, b = (frame[good[frame["doc"].to_numpy()]].reset_index(drop=True) for frame in (a, b))
    link_a, link_b = _aligned(a, b)
    text, begins, place_a = _written_groups(sides, a, b, link_a, link_b)

    ordinals = np.arange(len(texts) + 1)
    from_a, from_b = (np.searchsorted(frame["doc"].to_numpy(), ordinals) for frame in (a, b))
    from_link = np.searchsorted(link_a, from_a)
    found = []
    for i in range(len(texts)):
        n_a, n_b = int(from_a[i + 1] - from_a[i]), int(from_b[i + 1] - from_b[i])
        digest = ""
        if n_a:
            begin = begins[place_a[from_a[i]]]
            end = begins[place_a[from_a[i + 1]]] if from_a[i + 1] < len(a) else len(text)
            digest = hashlib.sha256(text[begin + 1 : end]).hexdigest()  # without the mark before its first group
        found.append((n_a, n_b, int(from_link[i + 1] - from_link[i]), digest))
    pairs = (a["id"].to_numpy()[link_a] << 32) | b["id"].to_numpy()[link_b]
    return found, pairs, np.diff(from_link)


def _stored_documents(a_file: str, b_file: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sides = _sides(a_file, b_file)
    first_chunk = TaskContext.get().partitionId() << 32
    chunks = 0
    held: list[tuple[pa.Array, list[tuple], np.ndarray, np.ndarray]] = []

    def chunk() -> pa.RecordBatch:
        nonlocal chunks
        ids = pa.concat_arrays([part[0] for part in held])
        found = [row for part in held for row in part[1]]
        distinct, of, times = np.unique(np.concatenate([part[2] for part in held]), return_inverse=True, return_counts=True)
        ends = np.cumsum(np.concatenate([part[3] for part in held]))
        held.clear()
        links = [np.sort(part).astype("<u4").tobytes() for part in np.split(of, ends[:-1])]
        others = [None] * (len(found) - 1)
        n_a, n_b, groups, digests = (list(column) for column in zip(*found))
        chunks += 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(found), first_chunk + chunks)), ids, *(pa.array(n, pa.int64()) for n in (n_a, n_b, groups, groups)),
                pa.array(digests, pa.string()), pa.array(links, pa.binary()),
                # The chunk's list stands in its first row.
                pa.array([distinct, *others], pa.list_(pa.int64())), pa.array([times.astype(np.int32), *others], pa.list_(pa.int32())),
            ],
            names=["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "pairs", "times"],
        )

    for batch in batches:
        texts, first, chars = [], 0, 0
        for at in range(batch.num_rows):
            texts.append(batch.column(1)[at].as_py())
            chars += len(texts[-1] or "")
            if chars >= CHARS_AT_ONCE or at == batch.num_rows - 1:
                held.append((batch.column(0).slice(first, len(texts)), *_documents(sides, texts)))
                texts, first, chars = [], at + 1, 0
                if sum(len(part[2]) for part in held) >= LINKS_OF_A_CHUNK:
                    yield chunk()
    if held:
        yield chunk()


def _summed(documents: pa.Table, totals: pa.Table) -> pa.Table:
    """One chunk's documents with the totals of their links; ``totals`` has (of_chunk, place, total, best)."""
    place = totals["place"].to_numpy()
    total = np.zeros(len(place), dtype=np.int64)
    best = np.zeros(len(place), dtype=np.int64)
    total[place], best[place] = totals["total"].to_numpy(), totals["best"].to_numpy(zero_copy_only=False)
    links = [np.frombuffer(row.as_buffer(), dtype="<u4") for row in documents["links"]]
    documents = documents.drop_columns(["chunk", "links"])
    documents = documents.append_column("n_best", pa.array([int(best[of].sum()) for of in links], pa.int64()))
    return documents.append_column("count_sum", pa.array([int(total[of].sum()) for of in links], pa.int64()))


def aligned_tokens(documents: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    Side A is a byte-level vocabulary and encodes a space and the text, side B a sentencepiece model, which puts that space
    itself. n_links counts linked tokens; count_sum adds up how often each link's two ids are linked in the
    whole corpus, n_best counts the links to the A id, or one of those, that their B id is linked with most often there.
    groups_sha256 is the digest of `a1,a2|b1;a3|b2,b3`, ids group by group.

    ``documents`` needs doc_id and text; further columns are ignored, whatever their names. A null or empty text,
    and one whose tokens do not stand for its bytes, has no tokens: zeros and an empty digest. Null ids stay null, and
    repeated rows count each time. A very long text is held whole, one at a time. An empty table gives no rows.
    """
    kind = dict(documents.dtypes)["doc_id"]
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    stored = materialize(texts.mapInArrow(partial(_stored_documents, a_file, b_file), _STORED.format(id=kind)))

    lists = stored.where("pairs is not null").select("chunk", F.explode(F.arrays_zip("pairs", "times")).alias("entry"))
    counts = lists.groupBy(F.col("entry.pairs").alias("pair")).agg(F.sum(F.col("entry.times").cast("long")).alias("total"))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    # As many rows as B has ids at most.
    highest = counts.groupBy("b").agg(F.max("total").alias("highest"))
    judged = materialize(counts.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best")))
    places = stored.where("pairs is not null").select(F.col("chunk").alias("of_chunk"), F.posexplode("pairs").alias("place", "pair"))
    totals = places.join(judged, "pair").select("of_chunk", "place", "total", "best")

    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = stored.select("chunk", *columns, "links").groupBy("chunk").cogroup(totals.groupBy("of_chunk"))
    result = rows.applyInArrow(
        _summed, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )
    return result.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
