"""Token ids by a file of the tokenizers library, with words remembered between texts."""

from __future__ import annotations

import os
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerlens.llm.held import held

#: Texts that are encoded as one piece. Beyond Latin letters, what counts as a letter or as white
#: space may differ between versions of the character tables; and next to other white space a
#: space is no safe place to cut.
_WHOLE = r"[^\t\n\r\x20-\x7e\xa1-\x{24f}]|^ | $| [ \t\n\r]|[\t\n\r] "

#: A letter before a mark that ends its piece; apostrophes may belong to both.
_ENDED = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"

#: A space and letters: such a unit is one piece of the pre-tokenizer.
_WORD = r"^ [A-Za-z]+$"

#: Character between units; it is unusual, so no text that is cut holds it.
_CUT = "\x00"

#: Units remembered by a Python worker (about 200 bytes each).
REMEMBERED = 500_000

#: Units not seen before that are handed to the library as one text.
_TOGETHER = 32


class Encoder:
    """Encode texts as the tokenizers library does, without special tokens.

    The pre-tokenizer always ends a piece where a space follows a non-space, at a line end
    without white space beside it, and where a punctuation mark follows a letter, so the text between
    such places (a unit) has the same ids wherever it stands. Units are told apart by Arrow, encoded
    once by the library and remembered, up to ``REMEMBERED`` of them; Arrow puts the ids together.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        # The library's own cache of words costs more than it saves where every unit is new.
        self.library.model._resize_cache(0)
        self.spelled = Tokenizer.from_file(path)
        self.spelled.model._resize_cache(0)
        self.spelled.pre_tokenizer = WhitespaceSplit()
        self.known: dict[str, bytes] = {}

        vocabulary = self.library.get_vocab()
        self.leads = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.leads[[number for token, number in vocabulary.items() if token.startswith("Ġ")]] = True

    @staticmethod
    def _encode(library, texts: list[str]) -> list[bytes]:
        """Ids of every text by the library."""
        lists = [one.ids for one in library.encode_batch_fast(texts, add_special_tokens=False)]
        ends = list(accumulate(map(len, lists)))
        raw = np.fromiter(chain.from_iterable(lists), "<u4", ends[-1] if ends else 0).tobytes()
        return [raw[4 * begin : 4 * end] for begin, end in zip([0, *ends], ends)]

    def _known(self, units: pa.Array) -> list[bytes]:
        """Ids of distinct units; those not seen before are encoded and remembered."""
        known, names = self.known, _list(units)
        fresh = [unit not in known for unit in names]
        if len(known) + sum(fresh) > REMEMBERED:
            known = self.known = {unit: known[unit] for unit, new in zip(names, fresh) if not new}
        some = units.filter(pa.array(fresh, pa.bool_()))
        word = pc.match_substring_regex(some, _WORD)
        others = _list(some.filter(pc.invert(word)))
        known.update(zip(others, self._encode(self.library, others)))
        # Many in one text: a word begins where a token leads with a space. In the vocabulary a
        # space is written as this letter and other plain letters as themselves.
        led = _list(some.filter(word))
        for start in range(0, len(led), _TOGETHER):
            joined = " ".join(led[start : start + _TOGETHER]).replace("  ", " Ġ")
            raw = self._encode(self.spelled, ["Ġ" + joined[1:]])[0]
            edges = (np.flatnonzero(self.leads[np.frombuffer(raw, "<u4")]) * 4).tolist()
            parts = [raw[begin:end] for begin, end in zip(edges, [*edges[1:], len(raw)])]
            known.update(zip(led[start : start + _TOGETHER], parts, strict=True))
        return [known[unit] for unit in names]

    def _by_units(self, plain: pa.Array) -> list[bytes]:
        """Ids of texts that may be cut."""
        marked = pc.replace_substring_regex(plain, _ENDED, rf"\1{_CUT}\2")
        marked = pc.replace_substring(marked, " ", f"{_CUT} ")
        lines = pc.replace_substring(marked, "\n", f"{_CUT}\n{_CUT}")
        marked = pc.if_else(pc.match_substring_regex(plain, r"[\t\n\r ]{2}"), marked, lines)
        units = pc.split_pattern(marked, _CUT)
        coded = units.flatten().dictionary_encode()
        known = pa.array(self._known(coded.dictionary), pa.large_binary())
        ids = known.take(coded.indices)
        _, offsets, joined = ids.buffers()
        ends = np.frombuffer(offsets, np.int64, len(ids) + 1)
        edges = ends[np.cumsum(pc.list_value_length(units).to_numpy())].tolist()
        joined = joined.to_pybytes() if joined else b""
        return [joined[begin:end] for begin, end in zip([0, *edges], edges)]

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """For every text its ids as little-endian unsigned 32-bit integers."""
        plain = _strings(texts)
        whole = pc.match_substring_regex(plain, _WHOLE)
        pieces = iter(self._encode(self.library, plain.filter(whole).to_pylist()))
        joined = iter(self._by_units(plain.filter(pc.invert(whole))) if whole.false_count else [])
        return [next(pieces if one else joined) for one in whole.to_pylist()]


def _list(strings: pa.Array) -> list[str]:
    """Strings as a list; by way of numpy, which makes them faster than Arrow does."""
    return strings.to_numpy(zero_copy_only=False).tolist()


def _strings(texts: pa.Array | list[str]) -> pa.Array:
    """Texts, or their UTF-8 bytes, as strings; what is not UTF-8 is replaced as Python does."""
    if isinstance(texts, list):
        return pa.array(texts, pa.large_string())
    try:
        return texts.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([raw.decode("utf-8", "replace") for raw in texts.to_pylist()], pa.large_string())


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    return held(("words", path), lambda: Encoder(path))


def slices(batch, most_bytes: int = 4 << 20, column: str = "text"):
    """An Arrow batch in parts of a bounded number of text bytes (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > most_bytes:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)
