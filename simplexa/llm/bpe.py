"""Token ids of byte-level BPE tokenizers, a batch at a time.

The library splits a text into pieces by character class and merges each piece on its own.  Here the split is done on
arrays, and only pieces not met before are merged; the class of a character is asked of the library.  Texts an added token's text, and tokenizers of another build, go to the library whole.
"""

from __future__ import annotations

import json

import numpy as np

from simplexa.llm.words import mix, places, worker_state

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 9
SLICE_CHARS = 1 << 19
#: Pieces held by one worker before it starts afresh.
HELD_PIECES = 3_000_000
#: The endings that the split keeps together with their apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def tokenizer(path: str):
    """The tokenizer of a .json file, once for each worker."""
    state = worker_state()
    if ("tokenizer", path) not in state:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        state["tokenizer", path] = Tokenizer.from_file(path)
    return state["tokenizer", path]


def splits_by_class(path: str) -> tuple[bool, list[str], dict[bytes, int]]:
    """Whether pieces are independent and split by the byte-level pattern; the added tokens' texts; ids by bytes.

    Pieces are merged by `tiktoken`, in the order of ids.  That gives the same ids where every merge makes the next id,
    which is checked here.
    """
    with open(path, encoding="utf-8") as f:
        built = json.load(f)
    pre, model = built.get("pre_tokenizer") or {}, built["model"]
    plain = (
        model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
        and pre.get("use_regex", True) and not built.get("normalizer") and not model.get("dropout")
        and not built.get("truncation") and not built.get("padding")
    )
    added = [t["content"] for t in built.get("added_tokens", [])]
    if not plain:
        return False, added, {}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable}
    shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    vocab, ranks = model["vocab"], {}
    for text, i in vocab.items():
        if text not in added:
            ranks[bytes(shown[c] for c in text)] = i
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ordered = all(vocab["".join(m)] == 256 + i for i, m in enumerate(merges))
    return ordered and len(ranks) == 256 + len(merges), added, ranks


class Encoder:
    """ids(texts) gives one array of ids for each text."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.plain, self.added, ranks = splits_by_class(path)
        if self.plain:
            import tiktoken

            core = tiktoken.Encoding("pieces", pat_str="[^\\n]+|\\n+", mergeable_ranks=ranks, special_tokens={})
            self.merge = core._encode_single_piece
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.fresh()

    def fresh(self) -> None:
        self.flat = np.zeros(1 << 20, np.int32)
        self.ends = np.zeros(1 << 16, np.int64)
        self.keys, self.order, self.held = np.zeros(1 << 18, np.uint64), np.zeros(1 << 18, np.int32), 0

    def kind(self, c: str) -> int:
        pieces = self.library.pre_tokenizer.pre_tokenize_str
        for kind, mate in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(pieces(mate + c + mate)) == 1:
                return kind
        return SPACE

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        whole = [not self.plain or any(t in x for t in self.added) for x in texts]
        out: list[np.ndarray | None] = [None] * len(texts)
        for i, alone in enumerate(whole):
            if alone:
                out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.int32)
        chosen, size = [], 0
        for i, x in enumerate(texts):
            if whole[i]:
                continue
            chosen.append(i)
            size += len(x)
            if size >= SLICE_CHARS:
                self.some(texts, chosen, out)
                chosen, size = [], 0
        if chosen:
            self.some(texts, chosen, out)
        return out

    def some(self, texts: list[str], chosen: list[int], out: list) -> None:
        raw = "".join(texts[i] for i in chosen)
        lengths = np.array([len(texts[i]) for i in chosen], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        if not raw:
            for i in chosen:
                out[i] = np.zeros(0, np.int32)
            return
        chars = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = self.pieces(chars, offsets)
        hashed = self.hashes(chars, starts)
        rows = self.known(hashed)
        if (missing := np.flatnonzero(rows < 0)).size:
            bounds = np.append(starts, len(chars))
            self.learn(raw, bounds, hashed, missing)
            rows = self.known(hashed)
        begin, count = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        total = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(total[-1]) + np.repeat(begin - total[:-1], count)
        flat = self.flat[at]
        firsts = total[np.searchsorted(starts, offsets)]
        for k, i in enumerate(chosen):
            out[i] = flat[firsts[k] : firsts[k + 1]]

    def pieces(self, chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """First characters of the pieces."""
        n = len(chars)
        kinds = self.kinds[chars]
        if (kinds == UNKNOWN).any():
            for c in np.unique(chars[kinds == UNKNOWN]):
                self.kinds[c] = self.kind(chr(c))
            kinds = self.kinds[chars]
        heads = np.zeros(n + 1, bool)
        heads[offsets] = True
        last = heads[1:]
        heads = heads[:-1]
        space = kinds == SPACE
        changed = np.ones(n, bool)
        changed[1:] = kinds[1:] != kinds[:-1]
        start = changed | heads
        after = np.zeros(n, bool)  # a space before another kind of character in the same text
        after[:-1] = space[:-1] & ~space[1:]
        after &= ~last
        joined = np.zeros(n, bool)  # such a blank goes with what follows
        joined[1:] = (after & (chars == 32))[:-1]
        start |= after
        start &= ~joined
        marks = np.flatnonzero((chars == 39) & start)
        for ending in ENDINGS:
            m = marks[marks + len(ending) < n]
            hit = np.ones(len(m), bool)
            for j, c in enumerate(ending, 1):
                hit &= (chars[m + j] == ord(c)) & ~heads[m + j]
            m = m[hit]
            start[m + 1] = False
            beyond = m + 1 + len(ending)
            start[beyond[beyond < n]] = True
        return np.flatnonzero(start)

    @staticmethod
    def hashes(chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        lengths = np.diff(np.append(starts, len(chars)))
        place = np.arange(len(chars), dtype=np.int64) - np.repeat(starts, lengths)
        state = worker_state()
        if "chars" not in state:
            state["chars"] = mix(np.arange(1, 0x110001, dtype=np.uint64))
        each = state["chars"][chars] * places(int(lengths.max()) + 1)[place]
        return np.maximum(mix(np.add.reduceat(each, starts) + lengths.astype(np.uint64)), np.uint64(1))

    def known(self, hashed: np.ndarray) -> np.ndarray:
        """Numbers of pieces, -1 for new ones: an open hash table, probed for all pieces at once."""
        out = np.full(len(hashed), -1, np.int64)
        left, mask = np.arange(len(hashed)), np.uint64(len(self.keys) - 1)
        slot = hashed & mask
        while len(left):
            there = self.keys[slot]
            hit = there == hashed[left]
            out[left[hit]] = self.order[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + np.uint64(1)) & mask
        return out

    def place(self, new: np.ndarray, order: np.ndarray) -> None:
        left, mask = np.arange(len(new)), np.uint64(len(self.keys) - 1)
        slot = new & mask
        while len(left):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, one = np.unique(slot[free], return_index=True)
            taken = free[one]
            self.keys[slot[taken]] = new[left[taken]]
            self.order[slot[taken]] = order[left[taken]]
            on = np.ones(len(left), bool)
            on[taken] = False
            left, slot = left[on], (slot[on] + np.uint64(1)) & mask

    def learn(self, raw: str, bounds: np.ndarray, hashed: np.ndarray, missing: np.ndarray) -> None:
        new, first = np.unique(hashed[missing], return_index=True)
        if self.held + len(new) > HELD_PIECES and self.held:
            self.fresh()
            new, missing = np.unique(hashed, return_index=True)
        else:
            missing = missing[first]
        ids = [self.merge(raw[bounds[i] : bounds[i + 1]]) for i in missing]
        held, used = self.held, int(self.ends[self.held])
        counts = np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter((t for x in ids for t in x), np.int32, int(counts.sum()))
        while used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while held + len(new) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : used + len(flat)] = flat
        self.ends[held + 1 : held + len(new) + 1] = used + np.cumsum(counts)
        self.held += len(new)
        order = np.arange(held, self.held, dtype=np.int32)
        if 5 * self.held > 2 * len(self.keys):
            full = self.keys != 0
            new, order = np.append(self.keys[full], new), np.append(self.order[full], order)
            size = 4 * len(self.keys)
            while 5 * self.held > 2 * size:
                size *= 2
            self.keys, self.order = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        self.place(new, order)


def encoder(path: str) -> Encoder:
    state = worker_state()
    if ("encoder", path) not in state:
        state["encoder", path] = Encoder(path)
    return state["encoder", path]
