"""Encoding with a public tokenizer, each distinct piece of a word once."""

import functools
import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that are encoded together, between spaces: visible ASCII without special tokens, Latin-1 letters.
_PLAIN = r"^[!-;=-~À-ÖØ-öø-ÿ]+$"
#: A run of letters and the symbols behind it: the pre-tokenizer parts them, and case does not count.
_PARTED = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<symbols>[!-/:-@\[-`{-~]*)$"
#: What those two are in lower case. The pre-tokenizer leaves each whole, so the model alone encodes it.
_PART = r"^([a-zß-öø-ÿ]*|[!-/:-@\[-`{-~]*)$"
#: Pieces and bytes of them remembered per Python worker (or those of one call), and words encoded in one call.
REMEMBERED, REMEMBERED_BYTES, TOGETHER = 250_000, 8 << 20, 2_000


def _gathered(ids: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given rows of a ragged array, one behind the other, and their starts with the end."""
    sizes = np.diff(starts)[rows]
    found = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(sizes, out=found[1:])
    places = np.repeat(starts[rows] - found[:-1], sizes)
    places += np.arange(found[-1])
    return ids[places], found


class Encoder:
    """``encode`` equals the tokenizer's own ids of each whole text.

    It relies on a pre-tokenizer whose pieces never hold white space and part letters from symbols, and on a
    normalizer that lower-cases, as those of word_bpe: then the ids of a text are those of its space-separated
    words, and those of letters with symbols behind them are of the letters in lower case, then of the
    symbols. Arrow splits texts and finds distinct words and pieces, so Python sees distinct pieces only; ids
    are gathered from the table of pieces, which is an Arrow array too: a Python string for each would take ten
    times as much. Words of another form are pieces by themselves: plain ones are encoded many at a time and
    told apart by character offsets, all others one by one.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        spelt = self.tokenizer.pre_tokenizer.pre_tokenize_str
        #: Letters beyond ASCII as the model's alphabet of bytes spells them.
        self.spelling = str.maketrans({c: spelt(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c != "÷"})
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _learn_parts(self, parts: pa.Array) -> None:
        model, spelling, ids, sizes = self.tokenizer.model.tokenize, self.spelling, [], []
        for part in parts.to_pylist():
            tokens = model(part if part.isascii() else part.translate(spelling))
            ids.extend([x.id for x in tokens])
            sizes.append(len(tokens))
        self._add(parts, ids, sizes)

    def _learn_plain(self, words: pa.Array) -> None:
        for at in range(0, len(words), TOGETHER):
            group = words.slice(at, TOGETHER)
            names = group.to_pylist()
            encoding = self.tokenizer.encode(" ".join(names), add_special_tokens=False)
            begins = np.array([b for b, _ in encoding.offsets], np.int64)
            ends = np.cumsum([len(w) + 1 for w in names])
            self._add(group, encoding.ids, np.diff(np.searchsorted(begins, ends), prepend=0))

    def _learn_odd(self, words: pa.Array) -> None:
        encodings = self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)
        self._add(words, [i for x in encodings for i in x.ids], [len(x.ids) for x in encodings])

    def _add(self, pieces: pa.Array, ids: list[int], sizes: Sequence[int]) -> None:
        self.known = pa.concat_arrays([self.known, pieces])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The places of distinct pieces in the table, which learns those it lacks."""
        pieces = pieces.cast(pa.large_string())
        numbers = np.array(pc.index_in(pieces, self.known).fill_null(-1), np.int64)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            size = sum(pc.sum(pc.binary_length(x)).as_py() or 0 for x in (self.known, pieces.take(pa.array(new))))
            if len(self.known) + len(new) > REMEMBERED or size > REMEMBERED_BYTES:
                self._forget()
                new = np.arange(len(pieces))
            found = pieces.take(pa.array(new))
            alone, plain = (pc.match_substring_regex(found, x).to_numpy(zero_copy_only=False) for x in (_PART, _PLAIN))
            kinds = (alone, ~alone & plain, ~alone & ~plain)
            numbers[new[np.concatenate([np.flatnonzero(k) for k in kinds])]] = len(self.known) + np.arange(len(new))
            for learn, kind in zip((self._learn_parts, self._learn_plain, self._learn_odd), kinds, strict=True):
                learn(found.filter(pa.array(kind)))
        return numbers

    def encode(self, texts: Sequence[str | None] | pa.Array) -> list[np.ndarray]:
        """The ids of each text; null has none."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary
        parted = pc.extract_regex(distinct, _PARTED)
        letters = pc.coalesce(pc.utf8_lower(pc.struct_field(parted, "letters")), distinct)
        symbols = pc.struct_field(parted, "symbols").fill_null("")
        pieces = pa.concat_arrays([letters, symbols]).dictionary_encode()
        numbers = self._numbers(pieces.dictionary)[pieces.indices.to_numpy()]
        both = numbers.reshape(2, len(distinct)).T.reshape(-1)
        ids, starts = _gathered(self.ids, self.starts, both)
        ids, starts = _gathered(ids, starts[::2], words.indices.to_numpy())
        cuts = starts[np.cumsum(split.value_lengths().to_numpy())].tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per Python worker; the tasks that a worker runs share the pieces it knows."""
    return Encoder(path)
