"""Token ids of whole texts by a public word-piece vocabulary, remembered piece by piece."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

# The classes of the vocabulary's own splitting pattern, for the
# characters below. Words with any other character go to the tokenizer as they are.
SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ\x20\x09-\x0D]*")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^a-zß-öø-ÿ0-9\x20\x09-\x0D]+")


def vocabulary_path(path: str | None, default: str = "word_bpe_49k.json") -> str:
    """The given file, or the public one of that name."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(default)


class WordIds:
    """The tokenizer's ids, found piece by piece.

    White space always ends a token here, and so does a change between letters, digits
    and other signs, so the ids of a text are those of its lower-case pieces in a row.
    Pieces repeat more than words do, so they are kept in a table. It is bounded in entries
    and in the length of a piece, so in bytes: at most ``LIMIT`` of at most ``LONGEST``
    characters each; a full table starts afresh and longer pieces are not kept.
    """

    LIMIT = 3 << 17
    LONGEST = 64
    GROUP = 1 << 18  # bytes of text whose new pieces are learned at once

    def __init__(self, path: str):
        # one thread per task: Spark has a task on every core already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        suffix = spec["model"].get("end_of_word_suffix") or ""
        vocab = self.tokenizer.get_vocab()
        if not suffix or max(vocab.values()) >= 1 << 16:
            raise ValueError("a vocabulary with word ends and at most 65,536 ids is needed")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special) if special else "(?!)")
        self.cut = self._without_splitting(spec)
        self.known: dict[str, bytes] = {}

    def _without_splitting(self, spec: dict):
        """The tokenizer for lines of simple pieces, which need no rules to split them; itself where that gives other ids."""
        from tokenizers import Tokenizer

        steps = [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        bare = {"added_tokens": [], "normalizer": None, "post_processor": None, "truncation": None, "padding": None}
        made = Tokenizer.from_str(json.dumps(spec | bare | {"pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}))
        # every kind of piece: signs, digits, letters in and beyond ASCII, endings, runs of signs
        line = " ".join([chr(c) for c in [*range(33, 127), *range(0xDF, 0xF7), *range(0xF8, 0x100)] if not chr(c).isupper()])
        line += " the straße été señor qwxzvkj 's 't 're 've 'm 'll 'd ... $$$ !? <> <| |> ### %&* '' -- élève"
        same = made.encode(line, add_special_tokens=False).ids == self.tokenizer.encode(line, add_special_tokens=False).ids
        return made if same else self.tokenizer

    def _encode(self, text: str, tokenizer=None) -> np.ndarray:
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u2")

    def _simple(self, text: str) -> bool:
        return bool(SIMPLE.fullmatch(text)) and not self.special.search(text)

    def _pieces(self, raw: bytes) -> list[str]:
        """The pieces of a text; a word with unusual characters is one."""
        text = raw.decode("utf-8", "replace")
        if self._simple(text):
            return PIECES.findall(text.lower())
        out = []
        for word in raw.split():
            text = word.decode("utf-8", "replace")
            if self._simple(text):
                out += PIECES.findall(text.lower())
            else:
                out.append(text)
        return out

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """The ids of pieces that are not known; those of usual length are known from then on."""
        if len(self.known) + len(new) > self.LIMIT:
            self.known.clear()
        ids, simple = {}, []
        for piece in new:
            if self._simple(piece):
                simple.append(piece)
            else:
                ids[piece] = self._encode(piece).tobytes()
        for at in range(0, len(simple), 1024):
            part = simple[at : at + 1024]
            many = self._encode(" ".join(part), self.cut)
            # each piece ends with an id that is a word end, which cuts the ids up again
            cuts = np.flatnonzero(self.ends[many]) + 1
            if len(cuts) == len(part):
                raw, ends = many.tobytes(), (2 * cuts).tolist()
                ids.update((piece, raw[a:z]) for piece, a, z in zip(part, [0, *ends], ends))
            else:
                ids.update((piece, self._encode(piece).tobytes()) for piece in part)
        self.known.update((piece, i) for piece, i in ids.items() if len(piece) <= self.LONGEST)
        return ids

    def _group(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        pieces = [self._pieces(t) for t in texts]
        found = [list(map(self.known.get, p)) for p in pieces]
        new = self._learn({p for ps, f in zip(pieces, found) if None in f for p, i in zip(ps, f) if i is None})
        for p, f in zip(pieces, found):
            if None in f:
                f = [new[k] if i is None else i for k, i in zip(p, f)]
            yield np.frombuffer(b"".join(f), dtype="<u2")

    def texts(self, given: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text given in UTF-8, in order."""
        group, size = [], 0
        for text in given:
            group.append(text)
            size += len(text)
            if size >= self.GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def __call__(self, text: bytes) -> np.ndarray:
        """Ids of a text given in UTF-8."""
        return next(self._group([text]))


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str | None) -> WordIds:
    """The tokenizer of this worker process, loaded once."""
    path = vocabulary_path(path)
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
