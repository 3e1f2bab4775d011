"""Token ids of whole texts by a public tokenizer, by way of its distinct pieces.

Both vocabularies cut a text at white space before any merge, so the ids of a text are the ids of its pieces in turn.
Each distinct piece is encoded once a worker by the tokenizers library; a text is then a join of byte strings. A text
that holds the string of a special token goes through the library whole, which makes that string its special id.

Defined cases: null is the empty text, which has no ids; texts of any length are encoded whole; equal texts get equal ids.
"""

from __future__ import annotations

import os
import re
import unicodedata

#: The characters of Unicode's White_Space property.
_WHITE = "\t-\r \x85\xa0  -     　"
#: A byte-level piece is a word with the one blank before it, or a stretch of white space that no word takes from.
_BYTE_PIECES = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_WORD_PIECES = re.compile(f"[^{_WHITE}]+")
#: Distinct pieces that a worker remembers; beyond that it starts anew.
REMEMBERED = 1_500_000

#: ASCII signs that form a token of their own after a word; the apostrophe is left out, as contractions start with it.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_kept: dict[tuple[str, str], "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, the others by turn from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """`many` gives each text's ids as little-endian bytes of the given width."""

    def __init__(self, file: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = dtype
        self.pieces = _BYTE_PIECES if "byte_bpe" in os.path.basename(file) else _WORD_PIECES
        self.known: dict[str, bytes] = {}
        self.part, self.odd = ("\n", re.compile(f"[{_WHITE}]$")) if self.pieces is _BYTE_PIECES else (" \x01 ", re.compile("\x01"))
        self.part_ids = self.tokenizer.encode(self.part, add_special_tokens=False).ids
        self.letters = _byte_letters()
        self.lower = self.pieces is _WORD_PIECES
        self.model, self.width = self.tokenizer.model, int(dtype[-1])

    def plain_word(self, piece: str) -> str | None:
        """What the model itself takes for a word of letters alone, which needs no normalizing or cutting."""
        if not piece.removeprefix(" ").isalpha():
            return None
        if self.lower and not piece.isascii() and (piece != piece.lower() or not unicodedata.is_normalized("NFC", piece)):
            return None
        word = piece.lower() if self.lower else piece
        # an ASCII letter stands for itself
        return word.replace(" ", self.letters[32]) if word.isascii() else word.encode().decode("latin-1").translate(self.letters)

    def learn(self, new: list[str]) -> None:
        """Words go to the model as they are, signs after a word on their own, all else through the whole tokenizer."""
        known, rest, signed = self.known, set(), []
        for piece in new:
            core = piece.rstrip(_SIGNS)
            # a letter may end in a mark once it is lower-cased (U+0130 does), and marks go with the signs after them
            if core == piece or not core.removeprefix(" ").isalpha() or not core[-1].lower().isalpha():
                if not self.learn_word(piece):
                    rest.add(piece)
                continue
            tail = piece[len(core) :]
            if core not in known and not self.learn_word(core):
                rest.add(core)
            if tail not in known:
                rest.add(tail)
            signed.append((piece, core, tail))
        self.learn_texts(list(rest))
        for piece, core, tail in signed:
            known[piece] = known[core] + known[tail]

    def learn_word(self, piece: str) -> bool:
        word = self.plain_word(piece)
        if word is not None:
            self.known[piece] = b"".join([t.id.to_bytes(self.width, "little") for t in self.model.tokenize(word)])
        return word is not None

    def learn_texts(self, new: list[str]) -> None:
        """Many pieces in one text, parted by one that no piece can hold or touch."""
        import numpy as np

        encode = self.tokenizer.encode_batch_fast
        odd = [piece for piece in new if self.odd.search(piece)]
        self.known.update((piece, self.whole(piece)) for piece in odd)
        plain = [piece for piece in new if not self.odd.search(piece)] if odd else new
        width = int(self.dtype[-1])
        for k in range(0, len(plain), 5000):
            block = plain[k : k + 5000]
            ids = np.array(encode([self.part.join(block)], add_special_tokens=False)[0].ids, self.dtype)
            stop = np.append(np.flatnonzero(ids == self.part_ids[0]), len(ids))
            start = np.append(0, stop[:-1] + 1)
            raw = ids.tobytes()
            self.known.update(zip(block, [raw[a:b] for a, b in zip((start * width).tolist(), (stop * width).tolist(), strict=True)], strict=True))

    def whole(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def many(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for k in range(0, len(texts), 50):
            block = texts[k : k + 50]
            odd = {j for j, text in enumerate(block) for token in self.special if text and token in text}
            cuts = [() if j in odd else self.pieces.findall(text or "") for j, text in enumerate(block)]
            every = set().union(*cuts)
            new = [piece for piece in every if piece not in self.known]
            if len(self.known) + len(new) > REMEMBERED:
                self.known, new = {}, list(every)
            if new:
                self.learn(new)
            get = self.known.__getitem__
            out += [self.whole(block[j]) if j in odd else b"".join(map(get, cut)) for j, cut in enumerate(cuts)]
        return out


def encoder(file: str, dtype: str = "<u2") -> Encoder:
    if (file, dtype) not in _kept:
        _kept[file, dtype] = Encoder(file, dtype)
    return _kept[file, dtype]
