"""Token ids of whole texts from their distinct stretches.

A tokenizer that cuts a text into pieces before it merges gives equal ids for equal
stretches of text between borders that no piece ever crosses.  Texts are cut at such
borders, each distinct stretch is encoded once by the tokenizers library, and the ids
of the whole text are put together from them.  Stretches are told apart by their bytes
(Arrow's dictionary encoding and a dictionary of byte strings), never by a hash.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .common import row_blocks

# A worker keeps the ids of known stretches up to these bounds, then starts anew.
KNOWN_STRETCHES = 1_000_000
KNOWN_BYTES = 24 << 20
BLOCK_BYTES = 4 << 20
GROUP = 256

# Byte kinds for the cuts.
_OTHER, _LETTER, _MARK, _DIGIT, _BLANK, _BREAK = range(6)
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = _MARK
_KIND[32] = _BLANK
_KIND[10] = _BREAK
_VISIBLE = np.isin(np.arange(6), (_LETTER, _MARK, _DIGIT))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def literal_spans(data: np.ndarray, offsets: np.ndarray,
                  literals: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the ``literals`` in each text: the leftmost first, of
    those that start together the longest, none across two texts."""
    raw = data.tobytes()
    # A plain search finds the texts to look at, mostly none.
    found = [m.start() for x in literals if x in raw for m in re.finditer(b"(?=" + re.escape(x) + b")", raw)]
    texts = np.unique(np.searchsorted(offsets, np.array(found, np.int64), side="right") - 1)
    either = re.compile(b"|".join(map(re.escape, sorted(literals, key=len, reverse=True))))
    spans = [m.span() for t in texts for m in either.finditer(raw, int(offsets[t]), int(offsets[t + 1]))]
    both = np.array(spans, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of every byte, and where two different visible kinds meet (no piece of a
    letter run, a digit or a run of marks but the apostrophe goes on there)."""
    kind = _KIND[data]
    # U+00C0 to U+00FF are letters but for two signs.
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    visible = _VISIBLE[kind]
    meet = np.zeros(len(data), bool)
    meet[1:] = (kind[1:] != kind[:-1]) & visible[1:] & visible[:-1]
    return kind, meet


def _with_borders(cut: np.ndarray, data: np.ndarray, offsets: np.ndarray, literals: list[bytes]) -> np.ndarray:
    """Starts of stretches: where ``cut`` says and at every text's start; each of the
    ``literals`` is one stretch."""
    if literals:
        for low, high in zip(*literal_spans(data, offsets, literals)):
            cut[low + 1:high] = False
            cut[low] = True
            cut[high:high + 1] = True
    cut[np.unique(offsets[offsets < len(data)])] = True
    return np.flatnonzero(cut)


def byte_level_stretches(data: np.ndarray, offsets: np.ndarray,
                         literals: list[bytes] = ()) -> tuple[np.ndarray, np.ndarray]:
    """The texts, and starts of stretches that the byte-level pre-tokenizer never joins:
    every text's start; where visible kinds meet; a blank before something visible; a lone
    line break and what follows it.  The apostrophe is no mark, as its contractions join
    with letters."""
    kind, cut = _kinds(data)
    visible = _VISIBLE[kind]
    # A blank or line break between visible characters starts a stretch.
    single = np.zeros(len(data), bool)
    single[1:-1] = visible[:-2] & visible[2:] & ((kind[1:-1] == _BLANK) | (kind[1:-1] == _BREAK))
    cut |= single
    # After a line break (never after a blank, which joins the next word).
    cut[1:] |= single[:-1] & (kind[:-1] == _BREAK)
    return data, _with_borders(cut, data, offsets, literals)


def lowercase_stretches(data: np.ndarray, offsets: np.ndarray,
                        literals: list[bytes] = ()) -> tuple[np.ndarray, np.ndarray]:
    """The texts and starts of stretches for a tokenizer that composes (NFC), lower-cases,
    drops white space and cuts runs of letters, digits and runs of other signs apart:
    every text's start; white space after something else; where visible kinds meet, and
    between digits.

    Nothing composes with an ASCII character after it, so composing before or after such
    cuts is the same, and so is lower-casing A-Z before another ASCII character.  That is
    done here, for fewer stretches, unless it would make a literal."""
    kind, cut = _kinds(data)
    space = _SPACE[data]
    cut[1:] |= space[1:] & ~space[:-1]
    cut[1:] |= (kind[1:] == _DIGIT) & (kind[:-1] == _DIGIT)
    upper = (data >= 65) & (data <= 90)
    upper[:-1] &= data[1:] < 128
    lower = data + (upper * np.uint8(32))
    raw, lowered = data.tobytes(), lower.tobytes()
    starts = _with_borders(cut, data, offsets, literals)
    same = all(raw.count(x) == lowered.count(x) for x in literals)
    return lower if same else data, starts


class StretchEncoder:
    """Encodes batches of texts as a plain encode without special tokens around them
    does: literals of added tokens in a text get their ids."""

    def __init__(self, tokenizer_path: str,
                 cut: Callable[..., tuple[np.ndarray, np.ndarray]] = byte_level_stretches):
        # Spark runs a worker per core; threads of the library beside it only contend.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.terminals = self.tokenizer.get_vocab_size()
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or set(t.content) & set(" \t\n\v\f\r") for t in added):
            raise ValueError("added tokens that depend on what stands beside them are not supported")
        self.literals = [t.content.encode() for t in added]
        # Many stretches are encoded as one text with an added token's literal between
        # them; what has the first character of a literal is encoded by itself.
        self.first = {t.content[0] for t in added}
        self.between = next((t.content for t in added if not t.normalized and not set(t.content[1:]) & self.first), None)
        self.cut = cut
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and each text's count."""
        parts = [self._encode(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                 for low, high in row_blocks(offsets, BLOCK_BYTES)]
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([n for _, n in parts])

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Take in the stretches ``new``; their places, in a row with what was known."""
        texts = new.cast(pa.large_string())
        if self.between is None:
            alone = np.ones(len(new), bool)
        else:
            alone = pc.match_substring_regex(texts, "[" + re.escape("".join(self.first)) + "]").to_numpy(zero_copy_only=False)
        order = np.argsort(alone, kind="stable")
        new, texts = new.take(pa.array(order)), texts.take(pa.array(order)).to_pylist()
        n = len(texts) - int(alone.sum())
        groups = [self.between.join(texts[i:min(i + GROUP, n)]) for i in range(0, n, GROUP)] + texts[n:]
        parts, lengths = [], []
        border = self.tokenizer.token_to_id(self.between) if self.between else -1
        for i, e in enumerate(self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)):
            ids = np.array(e.ids, np.int32)
            if i * GROUP < n:
                at = np.flatnonzero(ids == border)
                lengths.append(np.diff(at, prepend=-1, append=len(ids)) - 1)
                ids = np.delete(ids, at)
            else:
                lengths.append([len(ids)])
            parts.append(ids)
        lengths = np.concatenate(lengths).astype(np.int32)
        ids = np.concatenate(parts)
        self.known = pa.concat_arrays([self.known, new])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths, dtype=np.int32) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        places = np.empty(len(new), np.int32)
        places[order] = len(self.starts) - len(new) + np.arange(len(new))
        return places

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n_texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n_texts, np.int64)
        data, starts = self.cut(data, offsets, self.literals)
        borders = np.append(starts, len(data)).astype(np.int64)
        parts = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))])
        coded = parts.dictionary_encode()
        words = coded.dictionary
        if len(self.known) + len(words) > KNOWN_STRETCHES or self.known.nbytes > KNOWN_BYTES:
            self._forget()
        # The table of a look-up is made each time: the block's words are fewer than the known.
        place = pc.index_in(self.known, value_set=words)
        seen = place.is_valid().to_numpy(zero_copy_only=False)
        slot = np.full(len(words), -1, np.int32)
        slot[place.drop_null().to_numpy()] = np.flatnonzero(seen)
        fresh = np.flatnonzero(slot < 0)
        if len(fresh):
            slot[fresh] = self._learn(words.take(pa.array(fresh)))
        slot = slot[coded.indices.to_numpy()]
        lengths = self.lengths[slot]
        ends = np.cumsum(lengths, dtype=np.int64)
        pick = np.arange(ends[-1], dtype=np.int32) + np.repeat((self.starts[slot] - ends + lengths).astype(np.int32), lengths)
        ids = self.ids[pick]
        # A text's count is what its stretches' ends rise by.
        borders = np.searchsorted(starts, offsets)
        before = np.append(0, ends)[borders]
        return ids, np.diff(before)


_encoders: dict[tuple, StretchEncoder] = {}


def shared_encoder(tokenizer_path: str, cut: Callable = byte_level_stretches) -> StretchEncoder:
    """This worker's encoder: what one task has learnt serves the next.  A worker keeps
    one encoder at a time."""
    key = (tokenizer_path, cut)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = StretchEncoder(tokenizer_path, cut)
    return _encoders[key]
