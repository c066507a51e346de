"""Whole texts to token ids by a public tokenizer, with the ids of frequent stretches remembered."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
from collections.abc import Callable, Iterator
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LONGEST = 64  # characters of a piece that is kept
STEP = 8_000_000  # bytes encoded at a time
NEW = 20_000  # pieces that go to the library at a time: what it tells of a token takes far more memory than its id

#: Usual texts hold ASCII and letters of Latin-1 only, which no normalisation changes; "<|" could begin a special string.
OTHER = r"[^\t\n\r\x20-\x7e\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]|<\|"
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
MARKED = rf"([{LETTERS}])([!-&(-/:-@\[-`{{-~])"  # a letter and a mark; an apostrophe may belong to the letter after it


def load(path: str):
    """The tokenizer, without truncation, padding or threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def frugal(task: Callable) -> Callable:
    """The task, which gives its memory back to the system when it ends: worker processes live on and add up."""

    def run(batches):
        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text, null as empty, without a detour through str."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def steps(column: pa.Array, step: int = STEP) -> Iterator[pa.Array]:
    """The texts in runs of about `step` bytes."""
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(column):
        end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + step)) + 1
        yield column.slice(start, end - start)
        start = end


def listed(found: list[bytes]) -> pa.ListArray:
    """Ids of each piece, as numbers."""
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 2)
    return cut_at(np.frombuffer(b"".join(found), "<u2"), ends)


def cut_at(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """The ids in a row, as lists that end at `ends`."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.uint16()))


class Encoder:
    """Token ids of texts as 16-bit numbers, by the library.

    A text is cut into pieces between which the tokenizer starts anew. Their ids are remembered; new pieces go to the library
    many at a time, as one text in which the ids of each can be told apart. Pieces and ids are Arrow arrays, of some 30 bytes
    a piece: none but new pieces become objects of Python. They outlive a task: the next one of its worker process starts with them.
    """

    MEMORY: ClassVar[dict[tuple[type, str], tuple[pa.StringArray, pa.ListArray]]] = {}  # per kind and vocabulary, in this process

    KEPT: int  # pieces remembered; beyond that, those of the last run of texts only
    ODD: str  # texts that go another way, as a pattern of Arrow

    def __init__(self, path: str):
        self.tokenizer, self.key = load(path), (type(self), path)

    def pieces(self, texts: pa.Array) -> pa.ListArray:
        """The pieces of usual texts."""
        raise NotImplementedError

    def stretches(self, text: str) -> list[str]:
        """The pieces of any text, as they stand there."""
        raise NotImplementedError

    def fresh(self, pieces: pa.StringArray) -> pa.ListArray:
        """Ids of pieces not seen before."""
        raise NotImplementedError

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of each text, null as empty."""
        for run in steps(column.cast(pa.string()).fill_null("")):
            odd = pc.match_substring_regex(run, self.ODD)
            usual = iter(self.usual(run.filter(pc.invert(odd))))
            for k, strange in enumerate(odd.to_pylist()):
                yield self.unusual(run[k].as_py()) if strange else next(usual)

    def usual(self, texts: pa.Array) -> list[bytes]:
        """Each different piece is looked up once; Arrow then gathers the ids."""
        lists = self.pieces(texts)
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary
        known, ids = self.MEMORY.get(self.key) or (pa.array([], pa.string()), listed([]))
        place = pc.index_in(pieces, value_set=known)
        lost = pc.is_null(place)
        new = pieces.filter(lost)
        both = pa.concat_arrays([ids, *[self.fresh(new.slice(at, NEW)) for at in range(0, len(new), NEW)]])
        place = pc.replace_with_mask(place, lost, pa.array(np.arange(len(known), len(both)), pa.int32()))
        found = both.take(place.take(coded.indices))
        if len(both) > self.KEPT:
            both = both.take(place)
        else:
            pieces = pa.concat_arrays([known, new])
        short = pc.less_equal(pc.utf8_length(pieces), LONGEST)
        self.MEMORY[self.key] = pieces.filter(short), both.filter(short)
        out, ends = found.values.to_numpy(), found.offsets.to_numpy()
        edges = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return [out[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist())]

    def unusual(self, text: str) -> bytes:
        """Ids of a text by way of its stretches."""
        parts = self.stretches(text)
        return b"".join(self.library(parts))

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype="<u2").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def together(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u2")


class WordEncoder(Encoder):
    """For vocabularies that drop white space and mark word ends: neither token, special string nor normalisation reaches
    across ASCII white space, and each unit of a piece ends with the one id in it that is marked."""

    KEPT = 600_000
    ODD = OTHER
    UNIT = rf"[{LETTERS}]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\s0-9{LETTERS}]+"
    SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")

    def __init__(self, path: str):
        super().__init__(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def pieces(self, texts: pa.Array) -> pa.ListArray:
        """Words, and what follows them: a unit ends between a letter and a mark, and white space is dropped, so some more is no harm."""
        return pc.ascii_split_whitespace(pc.utf8_lower(pc.replace_substring_regex(texts, MARKED, r"\1 \2")))

    def stretches(self, text: str) -> list[str]:
        return [w for w in self.SPACE.split(text) if w]

    def fresh(self, pieces: pa.StringArray) -> pa.ListArray:
        ids = self.together(" ".join(pieces.to_pylist()))
        marked = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        units = np.cumsum(pc.count_substring_regex(pieces, self.UNIT).to_numpy(), dtype=np.int64)
        if (units[-1] if len(units) else 0) != len(marked) - 1:
            return listed(self.library(pieces.to_pylist()))
        return cut_at(ids, marked[units])


class ByteEncoder(Encoder):
    """For byte-level vocabularies: ids stand for bytes one to one, so that pieces of known length can be told apart."""

    KEPT = 600_000
    #: Next to other white space, a space isn't a start by itself; nor is a line feed that two others follow, or one at the end.
    ODD = OTHER + r"|[ \n] | \n|\t|\r|^ | $|\n\n\n|\n\n$"
    STOP = MARKED  # a token starts at a mark after a letter
    START = re.compile(r"(?<=\S)(?=[ \n]\S)")  # a token starts at a single space or line feed between two other characters
    BARE = "\0"  # before a piece that no space goes before; usual texts hold no such character

    def __init__(self, path: str):
        super().__init__(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])

    def pieces(self, texts: pa.Array) -> pa.ListArray:
        lines = pc.replace_substring(pc.binary_join_element_wise(self.BARE, texts, ""), "\n", f" {self.BARE}\n")
        return pc.split_pattern(pc.replace_substring_regex(lines, self.STOP, rf"\1 {self.BARE}\2"), " ")

    def stretches(self, text: str) -> list[str]:
        return [w for w in self.START.split(text) if w]

    def fresh(self, pieces: pa.StringArray) -> pa.ListArray:
        """A piece goes to the library as it stands in a text: with its space, or bare. All but those that begin with neither
        space nor line feed go there in one text."""
        sent = pc.replace_substring_regex(pc.binary_join_element_wise(" ", pieces, ""), f"^ {self.BARE}", "")
        alone = pc.invert(pc.match_substring_regex(sent, r"^[ \n][^ \n]"))
        rest = sent.filter(pc.invert(alone))
        ids = self.together("".join(rest.to_pylist()))
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum(pc.binary_length(rest).to_numpy(), dtype=np.int64)
        last = np.searchsorted(ends, wanted)
        if len(ids) and (ends[np.minimum(last, len(ends) - 1)] == wanted).all():
            made = cut_at(ids, last + 1)
        else:
            made = listed(self.library(rest.to_pylist()))
        bare = listed(self.library(sent.filter(alone).to_pylist()))
        order = np.argsort(np.argsort(alone.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        return pa.concat_arrays([made, bare]).take(pa.array(order))
