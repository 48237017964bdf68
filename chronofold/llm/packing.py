"""Filling fixed-capacity containers with texts sized in tokens."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.skew import distributed_rank
from chronofold.session import materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that belongs to the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to their numbers of tokens: rank files (.tiktoken), tokenizers (.json), sentencepiece (.model)."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(enc.encode_ordinary(t)) for t in texts]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        return lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    piece = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in piece.encode(texts, num_threads=1)]


def cut(text: str, capacity: int, n_tokens: int, count: Callable[[list[str]], list[int]]) -> list[tuple[int, str, int]]:
    """(start, piece, tokens) of a text in order: pieces of at most ``capacity`` tokens as long as can be, cut between words where a word fits.

    A single character of more tokens than the capacity is a piece of its own.
    """
    if n_tokens <= capacity:
        return [(0, text, n_tokens)]
    out, pos, per = [], 0, max(1.0, len(text) / n_tokens)
    while pos < len(text):
        far = min(len(text), pos + max(16, int(per * capacity * 2)))
        if count([text[pos:far]])[0] <= capacity and far == len(text):
            end = far
        else:
            lo, hi = pos + 1, far
            while lo < hi:
                mid = (lo + hi + 1) // 2
                lo, hi = (mid, hi) if count([text[pos:mid]])[0] <= capacity else (lo, mid - 1)
            end = lo
            blank = max(text.rfind(" ", pos + 1, end + 1), text.rfind("\n", pos + 1, end + 1))
            if end < len(text) and blank > pos + (end - pos) * 3 // 4 and count([text[pos:blank]])[0] <= capacity:
                end = blank
        piece = text[pos:end]
        out.append((pos, piece, count([piece])[0]))
        pos = end
    return out


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, piece_no, start_char, n_tokens, text): every text once, cut only if it is larger than ``capacity``. Null counts as empty; an empty text has 0 tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(tokenizer)
        for b in batches:
            texts = [t or "" for t in b["text"]]
            rows = []
            for i, t, n in zip(b["id"], texts, count(texts), strict=True):
                rows += [(i, k, start, size, piece) for k, (start, piece, size) in enumerate(cut(t, capacity, n, count))]
            yield pd.DataFrame(rows, columns=["id", "piece_no", "start_char", "n_tokens", "text"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, piece_no int, start_char int, n_tokens int, text string")


def length_buckets(histogram: dict[int, int], capacity: int, buckets: int = 16) -> list[int]:
    """Upper ends of at most ``buckets`` length classes with the least room lost, by dynamic programming over the histogram.

    A container of the class with end b holds capacity // b items, whatever their lengths up to b.
    """
    sizes = sorted(histogram)
    if not sizes:
        return []
    upto = np.concatenate([[0], np.cumsum([histogram[s] for s in sizes])]).astype(float)
    slots = np.array([max(1, capacity // s) for s in sizes], float)
    # room[i, j]: containers for the sizes i..j in one class
    room = np.ceil((upto[None, 1:] - upto[:-1, None]) / slots[None, :])
    room[np.tril_indices(len(sizes), -1)] = np.inf
    best, back = np.concatenate([[0.0], np.full(len(sizes), np.inf)]), []
    for _ in range(min(buckets, len(sizes))):
        cost = best[:-1, None] + room
        back.append(cost.argmin(axis=0))
        best = np.concatenate([[0.0], cost.min(axis=0)])
    ends, at = [], len(sizes)
    for choice in reversed(back):
        if at:
            ends.append(sizes[at - 1])
            at = int(choice[at - 1])
    return sorted(ends)


def plan_containers(histogram: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple[int, int, int, int, int]]], int]:
    """Best-fit decreasing on the histogram: for each size the runs (first rank, how many, per container, first container, offset), and the number of containers.

    Sizes are placed from the largest down, each into the containers that it leaves the least room; containers filled alike so far are one group, so
    the plan is as large as the histogram (at most ``capacity`` sizes), not as the data.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> groups (first container, how many)
    plan: dict[int, list[tuple[int, int, int, int, int]]] = {}
    total = 0
    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        free = size
        for free in sorted(room):
            if free < size or not left:
                continue
            per, groups = free // size, room.pop(free)
            while groups and left:
                first, many = groups.pop()
                use = min(many, left // per)
                if use:
                    plan.setdefault(size, []).append((rank, use * per, per, first, capacity - free))
                    room.setdefault(free - per * size, []).append((first, use))
                    rank, left = rank + use * per, left - use * per
                if use < many and 0 < left < per:
                    plan.setdefault(size, []).append((rank, left, left, first + use, capacity - free))
                    room.setdefault(free - left * size, []).append((first + use, 1))
                    rank, left, use = rank + left, 0, use + 1
                if use < many:
                    groups.append((first + use, many - use))
            if groups:
                room.setdefault(free, []).extend(groups)
        if left:
            per = capacity // size
            whole, rest = divmod(left, per)
            for many, each in ((whole, per), (1, rest)):
                if many and each:
                    plan.setdefault(size, []).append((rank, many * each, each, total, 0))
                    room.setdefault(capacity - each * size, []).append((total, many))
                    rank, total = rank + many * each, total + many
    return plan, total


def _histogram(cut_up: DataFrame, capacity: int) -> DataFrame:
    return cut_up.select("id", "piece_no", F.least(F.greatest("n_tokens", F.lit(1)), F.lit(capacity)).alias("size"))


def pack(docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, piece_no, start_char, n_tokens, container_id, token_offset, text): containers of at most ``capacity`` tokens, as few as best fit gets.

    Texts are sized once. The histogram of sizes (at most ``capacity`` rows) is planned on the driver; each piece then finds
    its container by its rank among pieces of its size, which is found without one task holding a size. Equal (id, piece) rows are kept.
    Empty texts take the room of one token, so a container holds at most ``capacity`` of them; a character of more tokens than the capacity has a container of its own.
    """
    cut_up = materialize(pieces(docs, id_col, text_col, capacity, tokenizer).withColumn("row_no", F.monotonically_increasing_id()))
    sizes = _histogram(cut_up.drop("id").withColumnRenamed("row_no", "id"), capacity)
    plan, _ = plan_containers({r["size"]: r["n"] for r in sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}, capacity)
    runs = {s: tuple(np.array(x, np.int64) for x in zip(*p, strict=True)) for s, p in plan.items()}

    @F.pandas_udf("container_id long, token_offset int")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        box, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        s, r = size.to_numpy(), rank.to_numpy() - 1
        for v in np.unique(s):
            mine = np.flatnonzero(s == v)
            first, _, per, start, offset = runs[int(v)]
            k = np.searchsorted(first, r[mine], side="right") - 1
            within = r[mine] - first[k]
            box[mine], off[mine] = start[k] + within // per[k], offset[k] + within % per[k] * v
        return pd.DataFrame({"container_id": box, "token_offset": off.astype(np.int32)})

    ranked = distributed_rank(sizes, ["size"], F.md5(F.concat_ws("|", "id", "piece_no")), ["id", "piece_no"], "rank")
    placed = ranked.select(F.col("id").alias("row_no"), place("size", "rank").alias("p")).select("row_no", "p.container_id", "p.token_offset")
    return cut_up.join(placed, "row_no").select("id", "piece_no", "start_char", "n_tokens", "container_id", "token_offset", "text")


def unpack(packed: DataFrame, capacity: int) -> DataFrame:
    """(id, text) of every item, put together again from its pieces in order; an error if a container holds more than ``capacity`` tokens in several pieces, or overlapping ones.

    Ids must be unique. A text of several pieces is as large as it was before.
    """
    line = Window.partitionBy("container_id").orderBy("token_offset", F.col("n_tokens").desc(), "id", "piece_no")
    end = F.col("token_offset") + F.greatest("n_tokens", F.lit(1))
    placed = packed.withColumns({"__before": F.lag(end).over(line), "__end": end})
    wrong = (F.col("token_offset") < F.coalesce("__before", F.lit(0))) | ((F.col("__end") > capacity) & (F.col("token_offset") > 0))
    sound = placed.select("id", F.struct("piece_no", F.when(wrong, F.raise_error(F.lit("containers overlap or overflow"))).otherwise(F.col("text")).alias("text")).alias("x"))
    return sound.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["text"]), "").alias("text"))


def bucket_batches(docs: DataFrame, id_col: str, text_col: str, capacity: int, buckets: int = 16, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, piece_no, start_char, n_tokens, bucket_end, container_id, text): batches of capacity // bucket_end items inside optimal length buckets.

    Every item has the place of its bucket's end, so a batch never exceeds ``capacity``. ``container_id`` counts within the bucket.
    """
    cut_up = materialize(pieces(docs, id_col, text_col, capacity, tokenizer).withColumn("row_no", F.monotonically_increasing_id()))
    sizes = _histogram(cut_up.drop("id").withColumnRenamed("row_no", "id"), capacity)
    ends = length_buckets({r["size"]: r["n"] for r in sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}, capacity, buckets) or [capacity]
    end = F.element_at(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e >= F.col("size")), 1)
    ranked = distributed_rank(sizes.withColumn("bucket_end", end), ["bucket_end"], F.md5(F.concat_ws("|", "id", "piece_no")), ["id", "piece_no"], "rank")
    placed = ranked.select(F.col("id").alias("row_no"), "bucket_end", F.floor((F.col("rank") - 1) / F.floor(F.lit(capacity) / F.col("bucket_end"))).alias("container_id"))
    return cut_up.join(placed, "row_no").select("id", "piece_no", "start_char", "n_tokens", "bucket_end", "container_id", "text")


def fill_report(packed: DataFrame, capacity: int, *keys: str) -> DataFrame:
    """(capacity, n_pieces, n_containers, fill): how full the containers are."""
    boxes = packed.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    return boxes.agg(F.lit(capacity).alias("capacity"), F.sum("n").alias("n_pieces"), F.count(F.lit(1)).alias("n_containers"), F.round(F.sum("tokens") / (F.count(F.lit(1)) * capacity), 4).alias("fill"))
