"""Exact token counts of every prefix of a text, by dynamic programming.

A sequence of BPE tokens is what encoding gives if and only if each two
neighbours are what encoding their joint string gives.  So for a word the last
token of each prefix's encoding follows from shorter prefixes: it is the one
token that ends there and gets on with the last token before it.  One pass
over a word thus counts all its prefixes; a text's table is its words' tables
laid end to end over running sums.  Truncation to a budget and all budget
questions are then look-ups, with no further encoding.

Prefixes are counted in code points of the text as the tokenizer normalises
it.  Counts hold no begin, end or added special tokens; a special token's
string inside a text counts as that token, as is the library's default.

Defined results: a null or empty text has no bytes and no tokens; repeated
rows get equal results.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import Kept, without_cycles

LIMIT = 2048
END = "</w>"
#: Pieces of text, in order, each with the blank before it; the last alternative is blanks at the end.
PIECES = r" *(?:'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^ \p{L}\p{N}]+)| +"

#: What the vocabulary file must do to a text before the merges; ``PIECES`` follows from it.
STEPS = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None), ("Split", r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), ("ByteLevel", None)]


def byte_letters() -> list[str]:
    """The letter for each byte: printable ones are themselves, the rest follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b if b in own else next(other)) for b in range(256)]


class Counter:
    """Prefix tables for a byte-level BPE vocabulary with word ends."""

    def __init__(self, data: str, cache_bytes: int = 150 << 20):
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(data)
        steps = [(x["type"], x.get("pattern", {}).get("Regex")) for k in ("normalizer", "pre_tokenizer") for x in (spec[k] or {}).get("normalizers", (spec[k] or {}).get("pretokenizers", []))]
        if steps != STEPS or spec["model"].get("end_of_word_suffix") != END:
            raise ValueError("these tables are for byte-level BPE with word ends over the words of PIECES; this vocabulary splits texts otherwise")
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(spec["model"]["merges"])}
        self.vocab = spec["model"]["vocab"].keys()
        self.normal = Tokenizer.from_str(data).normalizer.normalize_str
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, self.specials)) or "(?!)")
        self.letters, self.split = byte_letters(), regex.compile(PIECES).findall
        self.blank = re.compile("[\t-\r ]+")
        self.room, self.used, self.known, self.before = cache_bytes, 0, {}, {}
        self.joint: dict[tuple[str, str], bool] = {}
        self.parts = {a + b: (a, b) for a, b in reversed(self.rank)}
        self.spines: tuple[dict, dict] = ({}, {})
        self.prepare()

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE."""
        while len(symbols) > 1:
            rank, at = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 60:
                break
            pair, out, i = (symbols[at], symbols[at + 1]), [], 0
            while i < len(symbols):
                if tuple(symbols[i : i + 2]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def symbols(self, token: str) -> list[str]:
        return [*token[: -len(END) - 1], token[-len(END) - 1 :]] if token.endswith(END) else list(token)

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The parts of a token at one end of it, from its outermost symbol to itself, each with the rank that makes it grow."""
        held = self.spines[side]
        if (got := held.get(token)) is None:
            parts, grows = [token], [1 << 60]
            while (pair := self.parts.get(parts[-1])) is not None:
                grows.append(self.rank[pair])
                parts.append(pair[side])
            got = held[token] = list(zip(reversed(parts), reversed(grows), strict=True))
        return got

    def seam(self, a: str, b: str) -> tuple[str, str] | None:
        """The two parts that merge across the seam when the joint string of two tokens is encoded; None if the tokens stay.

        Only the parts at the seam matter: merges run by rank, and the seam
        closes if the parts that face each other there merge before either
        grows.  Of equal ranks the left one goes first.
        """
        left, right, i, j, never = self.spine(a, 1), self.spine(b, 0), 0, 0, 1 << 60
        while True:
            (x, grow_x), (y, grow_y) = left[i], right[j]
            across = self.rank.get((x, y), never)
            if across < grow_x and across <= grow_y and across < never:
                return x, y
            if grow_x == grow_y == never:
                return None
            if grow_x <= grow_y:
                i += 1
            else:
                j += 1

    def follows(self, a: str, b: str) -> bool:
        """Whether the joint string of two tokens encodes to just these."""
        if (got := self.joint.get((a, b))) is None:
            if len(self.joint) > 500_000:
                self.joint.clear()
            got = self.joint[a, b] = self.seam(a, b) is None
        return got

    def prepare(self) -> None:
        """Which tokens are what their own strings encode to."""
        stands = {t for t in self.vocab if t not in self.parts}
        for t, pair in sorted(self.parts.items(), key=lambda x: self.rank[x[1]]):
            if pair[0] in stands and pair[1] in stands and t in self.vocab and self.seam(*pair) == pair:
                stands.add(t)
        #: By string, 1 for a token within a word and 2 for one at its end.
        self.kinds: dict[str, int] = {}
        for t in stands:
            name = t.removesuffix(END)
            self.kinds[name] = self.kinds.get(name, 0) | (1 if name == t else 2)
        self.held = ahocorasick.Automaton()
        for name, kind in self.kinds.items():
            if name:
                self.held.add_word(name, (len(name), kind, name, name + END))
        self.held.make_automaton()

    def word(self, word: str) -> list[int]:
        """Of a word, the token count of each prefix of one code point or more, each as a word of its own.

        Tokens come from an automaton by ascending ends, so all that lies
        before is settled: where a prefix ends within the word, ``last`` and
        ``count`` hold the last token of its encoding and how many there are.
        """
        if word.isascii() and word.isprintable():
            s, n = word, len(word)
            whole = [True] * (n + 1)  # whether a code point ends here, so a word may
        else:
            letters, coded = self.letters, word.encode("utf-8", "surrogatepass")
            s, n = "".join([letters[b] for b in coded]), len(coded)
            whole = [b & 0xC0 != 0x80 for b in coded] + [True]
        last, count, out, joint, follows = [""] * (n + 1), [0] * (n + 1), [0] * (n + 1), self.joint.get, self.follows
        for j, (size, kind, token, final) in self.held.iter(s):
            j += 1
            i = j - size
            before = last[i]
            if i and not before:
                continue
            if kind & 1 and not last[j] and (not i or (follows(before, token) if (x := joint((before, token))) is None else x)):
                last[j], count[j] = token, count[i] + 1
            if kind & 2 and not out[j] and whole[j] and (not i or (follows(before, final) if (x := joint((before, final))) is None else x)):
                out[j] = count[i] + 1
        return out[1:] if len(word) == n else [x for x, end in zip(out[1:], whole[1:], strict=True) if end]

    def piece(self, piece: str) -> tuple[int, bytes, int]:
        """(tokens, table of prefixes, code points) of a piece with the blanks before it."""
        if (got := self.known.get(piece)) is None:
            got = self.before.get(piece)
            if got is None:
                word = piece.lstrip(" ")
                table = self.word(word) if word else []
                if word in ("'re", "'ve", "'ll"):  # a quote and a letter are two words until the third comes
                    table[1] = table[0] + self.word(word[1])[0]
                got = (table[-1] if word else 0, bytes(4 * (len(piece) - len(word))) + array("I", table).tobytes(), len(piece))
            if self.used > self.room:
                self.known, self.before, self.used = {}, self.known, 0
            self.known[piece] = got
            self.used += 350 + 5 * len(piece)
        return got

    def plain(self, text: str) -> np.ndarray:
        """The table of a text without special tokens: entry k is the count of its first k + 1 code points."""
        text = self.blank.sub(" ", text).lower() if text.isascii() else self.normal(text)
        if not text:
            return np.empty(0, np.int64)
        known = self.known.get
        counts, parts, sizes = zip(*[known(p) or self.piece(p) for p in self.split(text)], strict=True)
        total = np.array(counts, np.int64)
        return np.frombuffer(b"".join(parts), np.uint32) + np.repeat(np.cumsum(total) - total, sizes)

    def table(self, text: str | None) -> np.ndarray:
        """Entry k is the number of tokens of the first k code points of the normalised text."""
        text, at, base, parts = text or "", 0, 0, [np.zeros(1, np.int64)]
        for m in self.special.finditer(text) if any(x in text for x in self.specials) else ():
            whole = self.plain(text[at : m.start()] + m[0][:-1])
            before = self.plain(text[at : m.start()])
            parts += [whole + base]
            base += (int(before[-1]) if len(before) else 0) + 1
            parts.append(np.array([base]))
            at = m.end()
        return np.concatenate([*parts, self.plain(text[at:]) + base])


KEPT = Kept(Counter)


def kept_counter() -> Kept:
    """One counter for all tasks of a worker, as the words that it has met serve them all."""
    return KEPT


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of no more than ``budget`` tokens."""
    if table[-1] <= budget:
        return len(table) - 1
    return int(np.flatnonzero(table <= budget)[-1])


def tokens_between(table: np.ndarray, a: int, b: int) -> int:
    """How many tokens the prefix of ``b`` code points has beyond that of ``a``."""
    return int(table[b] - table[a])


def vocabulary(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def counted(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fits (code points of the normalised text within the limit)."""
    data = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept_counter().use(data.value) as own:
            for batch in without_cycles(batches):
                n, fits = [], []
                for text in batch.column("text"):
                    table = own.table(text.as_py())
                    n.append(int(table[-1]))
                    fits.append(longest_prefix(table, limit))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array(fits, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "fits"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, fits long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fits")


def tables(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``prefix_tokens``, the whole table of each text."""
    docs = docs.drop("prefix_tokens")
    data = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept_counter().use(data.value) as own:
            for batch in without_cycles(batches):
                for k in range(0, batch.num_rows, 200):
                    part = batch.slice(k, 200)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([own.table(x.as_py()) for x in part.column("text")], pa.list_(pa.int64()))], [*part.schema.names, "prefix_tokens"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", prefix_tokens array<long>")
