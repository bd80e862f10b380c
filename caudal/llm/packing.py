"""Hierarchical packing of documents into training sequences.

A document's full windows of the longest context become sequences of their own. What is left goes to
the shortest tier (128, 256, 512 or 1024 tokens) that holds it. Tiers are packed from the longest
down: a window opens with the largest remainder of its tier, and its gap is filled with the largest
remainders that fit from its own and the shorter tiers; when none fits, one is cut to size. So every
window comes out full. Tokens that can't fill a window at the end of a task are cut into powers of
two, so nothing is padded at all.

A task packs what it reads, in pools of ``POOL`` tokens, and the pool's rest goes on to the next: no
shuffle, bounded memory, and the same sequences when a task is run again. Sequences of equal tier are
grouped into steps of ``STEP`` tokens, so each step costs the same.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.text import in_small_batches

TIERS = (128, 256, 512, 1024)
LONGEST = TIERS[-1]
POOL = 2_000_000
STEP = 8 * LONGEST
END = 0


@lru_cache(maxsize=2)
def _encoder(name: str):
    """Token ids of a text under the tokenizer file ``name``.

    ``tokenizers`` defines the ids. Where the same vocabulary is there as ranks, ``tiktoken`` gives the same ids
    several times faster; a text with the name of a special token is left to ``tokenizers``.
    """
    import os

    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(name))
    special = [t.content for t in exact.get_added_tokens_decoder().values() if t.special]
    ranks_file = public_tokenizers.path(name.replace(".json", ".tiktoken"))
    fast = None
    if os.path.exists(ranks_file):
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if fast is None or any(s in text for s in special):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


class Packer:
    """Packs remainders ``(doc, start, length)`` into full windows; ``emit`` gets a sequence at a time."""

    def __init__(self, emit):
        self.emit = emit
        self.pool: dict[int, list] = defaultdict(list)
        self.mask = 0  # bit n: a remainder of n tokens is there
        self.tokens = 0

    def add(self, doc, start: int, length: int) -> None:
        if length:
            self.pool[length].append((doc, start))
            self.mask |= 1 << length
            self.tokens += length

    def _take(self, most: int):
        """The largest remainder of ``most`` tokens or fewer, else None."""
        fit = self.mask & ((1 << (most + 1)) - 1)
        if not fit:
            return None
        length = fit.bit_length() - 1
        doc, start = self.pool[length].pop()
        if not self.pool[length]:
            self.mask &= ~(1 << length)
        self.tokens -= length
        return doc, start, length

    def _fill(self, gap: int) -> list:
        """``gap`` tokens of remainders, the last one cut if need be. The pool holds as many."""
        out = []
        while gap:
            got = self._take(gap)
            if got is None:  # all are longer: the shortest gives its head
                length = (self.mask & -self.mask).bit_length() - 1
                doc, start, length = self._take(length)
                self.add(doc, start + gap, length - gap)
                got = doc, start, gap
            out.append(got)
            gap -= got[2]
        return out

    def pack(self) -> None:
        for k in range(len(TIERS) - 1, -1, -1):
            tier, floor = TIERS[k], TIERS[k - 1] if k else 0
            own = (1 << (tier + 1)) - (1 << (floor + 1))
            while self.mask & own and self.tokens >= tier:
                first = self._take(tier)
                self.emit(tier, [first, *self._fill(tier - first[2])])

    def finish(self) -> None:
        self.pack()
        while self.tokens:
            size = 1 << (self.tokens.bit_length() - 1)
            self.emit(size, self._fill(size))


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


FIELDS = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_id long"
)


def _pack_task(batches: Iterator[pd.DataFrame], tokenizer: str, with_ids: bool) -> Iterator[pd.DataFrame]:
    encode = _encoder(tokenizer)
    base = TaskContext.get().partitionId() << 40
    rows: list[tuple] = []
    count, steps, open_steps = 0, 0, {}

    def emit(tier: int, parts: list) -> None:
        nonlocal count, steps
        group = tier if tier in TIERS else 0
        step, free = open_steps.get(group, (0, 0))
        if free < tier:
            step, free, steps = steps, STEP, steps + 1
        open_steps[group] = step, free - tier
        offset = 0
        for (doc_id, ids), start, length in parts:
            own = ids[start : start + length]
            row = (doc_id, start, length, _crc(own), len(ids), base + count, offset, tier, base + step)
            rows.append((*row, own) if with_ids else row)
            offset += length
        count += 1

    names = [f.split()[0] for f in FIELDS.split(", ")] + ["ids"] * with_ids

    def flush() -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
        rows.clear()
        return frame

    packer, held = Packer(emit), 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids = encode(text) if text else []
            ids.append(END)
            doc = (doc_id, np.array(ids, np.uint32))
            full = len(ids) // LONGEST * LONGEST
            for start in range(0, full, LONGEST):
                emit(LONGEST, [(doc, start, LONGEST)])
            packer.add(doc, full, len(ids) - full)
            held += len(ids)
            if held >= POOL:
                packer.pack()
                held = packer.tokens
                yield flush()
    packer.finish()
    if rows:
        yield flush()


def pack(documents: DataFrame, tokenizer: str = "byte_bpe_50k.json", with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: where it stands in the document and in its sequence.

    A document is its token ids and then id 0, so a null or empty text is one token. Every id lies in one
    piece. ``tier`` is the length of the sequence and ``step_id`` its step group. ``with_ids`` adds the ids.
    Rows that repeat a doc_id, or lack it, are documents of their own.
    """
    rows = in_small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fields = FIELDS + ", ids array<long>" * with_ids
    return rows.mapInPandas(lambda batches: _pack_task(batches, tokenizer, with_ids), fields)
