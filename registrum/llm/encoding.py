"""Token ids of whole texts with public tokenizers, with a bounded memo of text pieces."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space with the piece after it. A line break alone between two pieces is a token of its own. Byte-level BPE never joins text
#: across the start of such a piece: its pattern ends every token before a run of white space, whose last space starts the next token.
PIECE = re.compile(r"\s*\S+|\s+")
#: In RE2's syntax what any of the libraries takes for white space; two such characters in a row; a piece without any but a space in front.
SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
RUN, WORD = f"[{SPACE}]{{2}}", f"\\A ?[^{SPACE}]+\\z"
#: Between two pieces.
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Characters of a text that are encoded at once; a text beyond that is cut between pieces.
CHUNK = 8 << 20


def hugging(path: str, literal: bool = False) -> Callable[[list[str]], list[list[int]]]:
    """Encodes lists of texts with a tokenizers file. literal: strings of special tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = literal
    return lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]


def ranked(path: str, pattern: str) -> Callable[[list[str]], list[list[int]]]:
    """Encodes lists of texts with a file of tiktoken ranks."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    t = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [t.encode_ordinary(x) for x in texts]


def parts(text: str | None, size: int) -> Iterator[str]:
    """The text in parts of about size characters, cut between pieces."""
    text, at = text or "", 0
    while len(text) - at > size and (m := SAFE.search(text, at + size)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pieces of all texts, number of each text's). Pieces begin at a space and at and behind a line break. Texts with runs of white
    space are cut before whole runs instead."""
    odd = pc.or_(pc.match_substring_regex(texts, RUN), pc.match_substring(texts, "\0"))
    plain = pc.if_else(odd, pa.scalar("", texts.type), texts)
    cut = pc.split_pattern(pc.replace_substring(pc.replace_substring(plain, " ", "\0 "), "\n", "\0\n\0"), "\0")
    n, flat = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype("i8"), cut.flatten()
    if pc.any(odd).as_py():
        mask = odd.to_numpy(zero_copy_only=False)
        lists = [PIECE.findall(x) for x in texts.filter(odd).to_pylist()]
        more = pa.array(chain.from_iterable(lists), flat.type)
        first = np.where(mask, 0, np.concatenate([[0], np.cumsum(n)[:-1]])) if len(n) else n
        sizes = np.array([len(x) for x in lists], "i8")
        n[mask], first[mask] = sizes, len(flat) + np.cumsum(sizes) - sizes
        flat = pa.concat_arrays([flat, more]).take(pa.array(spread(first, n)))
    return flat, n


def together(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Batches of about size bytes, joined from smaller ones, so that a piece is looked up once for many texts."""
    held: list[pa.RecordBatch] = []
    room = size
    for b in batches:
        if b.num_rows:
            held.append(b)
            room -= b.nbytes
        if room <= 0:
            yield pa.concat_batches(held)
            held, room = [], size
    if held:
        yield pa.concat_batches(held)


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] numbers), first[1], ..."""
    if not len(n):
        return np.zeros(0, "i8")
    ends = np.cumsum(n)
    return np.repeat(first - (ends - n), n) + np.arange(ends[-1])


class Encoder:
    """Ids of texts, as little-endian unsigned integers of width bytes.

    Pieces are found and told apart by Arrow; those met before are in a memo, the others are encoded once. A memo of limit pieces goes
    back to the third that came first, among which the common ones are, so memory is bounded.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], width: int, limit: int = 900_000):
        self.encode, self.dtype, self.limit = encode, np.dtype(f"<u{width}"), limit
        self.known = pa.array([""], pa.large_string())
        self.bounds, self.ids = np.zeros(2, "i8"), np.zeros(0, self.dtype)
        (self.line,) = encode(["\n"])[0]

    def __call__(self, texts: list[str | None], size: int = CHUNK) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, str]] = []
        room = size
        for k, text in enumerate(texts):
            for part in parts(text, size):
                held.append((k, part))
                room -= len(part)
                if room <= 0:
                    self._add(held, out)
                    held, room = [], size
        self._add(held, out)
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def _add(self, held: list[tuple[int, str]], out: list[list[np.ndarray]]) -> None:
        if held:
            for (k, _), x in zip(held, self.ids_of(pa.array([h[1] for h in held], pa.large_string())), strict=True):
                out[k].append(x)

    def ids_of(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.known) > self.limit:
            keep = self.limit // 3
            self.known = pa.concat_arrays([self.known.slice(0, keep)])
            self.bounds, self.ids = self.bounds[: keep + 1].copy(), self.ids[: self.bounds[keep]].copy()
        flat, n = pieces(texts)
        coded = flat.dictionary_encode()
        found = pc.index_in(coded.dictionary, value_set=self.known)
        at = found.fill_null(0).to_numpy().astype("i8")
        if found.null_count:
            missing = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
            at[missing] = self.learn(coded.dictionary.take(pa.array(missing)))
        at = at[coded.indices.to_numpy()]
        sizes = self.bounds[at + 1] - self.bounds[at]
        ids = self.ids[spread(self.bounds[at], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n)])]
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def learn(self, unseen: pa.Array) -> np.ndarray:
        """Puts pieces behind those in the memo; returns their places. A line break between two pieces without white space, but for a
        space in front, is a token of its own, so such pieces are encoded as the lines of one text."""
        simple = pc.match_substring_regex(unseen, WORD)
        order = np.argsort(~simple.to_numpy(zero_copy_only=False), kind="stable")
        lines = unseen.filter(simple)
        sizes, ids = [np.zeros(0, "i8")], [self.ids]
        for k in range(0, len(lines), 20_000):
            flat = np.array(self.encode(["\n".join(lines.slice(k, 20_000).to_pylist())])[0], self.dtype)
            ends = np.append(np.flatnonzero(flat == self.line), len(flat))
            sizes.append(np.diff(ends, prepend=-1) - 1)
            ids.append(flat[flat != self.line])
        for x in self.encode(unseen.filter(pc.invert(simple)).to_pylist()):
            sizes.append(np.array([len(x)]))
            ids.append(np.array(x, self.dtype))
        n = np.concatenate(sizes)
        place = np.empty(len(unseen), "i8")
        place[order] = len(self.known) + np.arange(len(unseen))
        self.known = pa.concat_arrays([self.known, unseen.take(pa.array(order))])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(n)])
        self.ids = np.concatenate(ids)
        return place


_encoders: dict[tuple, Encoder] = {}


def encoder(kind: str, path: str, width: int, literal: bool = False, pattern: str = "") -> Encoder:
    """One per Python worker and tokenizer."""
    key = (kind, path, width, literal, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(hugging(path, literal) if kind == "tokenizers" else ranked(path, pattern), width)
    return _encoders[key]
