"""Deep-shallow sorting of byte strings in groups: multikey quicksort to a shallow depth, blind tries below it.

The quicksort works on all blocks of a batch at once: each block takes its middle word as pivot, is divided in three, and the
equal part goes on to its next word. What still agrees at ``SHALLOW`` words has a long common prefix; a blind trie orders it,
which compares every string with one other only.
"""

from __future__ import annotations

import numpy as np

WORD = 7  # bytes of a word; its eighth byte counts those present, so that a string's end sorts before any byte
SHALLOW = 8  # words


def words_of(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Leading bytes of each string, zero-filled (n x WORD * SHALLOW), and the same as words (n x SHALLOW)."""
    width = WORD * SHALLOW
    flat = np.frombuffer(b"".join(s[:width].ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    sizes = np.array([len(s) for s in strings])
    present = np.clip(sizes[:, None] - np.arange(SHALLOW) * WORD, 0, WORD).astype(np.uint8)
    cells = np.concatenate([flat.reshape(len(strings), SHALLOW, WORD), present[:, :, None]], axis=2)
    return flat, np.ascontiguousarray(cells).view(">u8").reshape(len(strings), SHALLOW).astype(np.uint64)


def multikey(words: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows within their groups by their words, and a block number per place; rows of a block agree in all words."""
    order = np.argsort(groups, kind="stable")
    block = np.unique(groups[order], return_inverse=True)[1].astype(np.int64)
    depth = np.zeros(len(order), np.int64)
    while True:
        sizes = np.bincount(block, minlength=block[-1] + 1 if len(block) else 0)
        live = np.flatnonzero((sizes[block] > 1) & (depth < words.shape[1]))
        if not len(live):
            return order, block
        here = block[live]
        first = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
        counts = np.diff(np.append(first, len(here)))
        values = words[order[live], depth[live]]
        pivots = np.repeat(values[first + counts // 2], counts)
        side = np.where(values < pivots, 0, np.where(values > pivots, 2, 1))
        perm = np.argsort(here * 3 + side, kind="stable")
        order[live], side = order[live][perm], side[perm]
        # the equal part goes one word on; a word that is not full ends its string, and equal strings end together
        ended = (values[perm] & np.uint64(255)) < WORD
        depth[live] = np.where(side == 1, np.where(ended, words.shape[1], depth[live] + 1), depth[live])
        fresh = block * 3 + 1
        fresh[live] = here * 3 + side
        block = np.cumsum(np.concatenate([[0], fresh[1:] != fresh[:-1]]))


def common(a: bytes, b: bytes, low: int = 0) -> int:
    """Length of the common prefix, known to be ``low`` at least."""
    high = min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def blind_order(strings: list[bytes], low: int) -> list[tuple[int, int]]:
    """(index, common prefix with the one before) of strings that share ``low`` bytes, in order; the first has ``low``.

    A trie node is [depth, children by the byte there]; -1 stands for a string's end; a leaf is a list of equal strings. An
    insertion descends by branching bytes alone, compares with the leaf it meets, and turns off where the two differ.
    """
    top: object = [0]
    for i, text in enumerate(strings[1:], 1):
        size, path, node = len(text), [], top
        while isinstance(node, tuple):
            path.append(node)
            at, kids = node
            node = kids.get(text[at] if at < size else -1) or next(iter(kids.values()))
        other = strings[node[0]]
        same = common(text, other, low)
        if same == size == len(other):
            node.append(i)
            continue
        mine, theirs = (text[same] if same < size else -1), (other[same] if same < len(other) else -1)
        while path and path[-1][0] > same:
            node = path.pop()
        if path and path[-1][0] == same:
            path[-1][1][mine] = [i]
            continue
        fork = (same, {theirs: node, mine: [i]})
        if path:
            at, kids = path[-1]
            kids[text[at] if at < size else -1] = fork
        else:
            top = fork
    out: list[tuple[int, int]] = []
    waiting: list[tuple[object, int]] = [(top, low)]
    while waiting:
        node, shared = waiting.pop()
        if isinstance(node, tuple):
            at, kids = node
            names = sorted(kids)
            waiting += [(kids[c], at) for c in reversed(names[1:])]
            waiting.append((kids[names[0]], shared))
        else:
            out += [(node[0], shared), *[(i, len(strings[i])) for i in node[1:]]]
    return out


def ordered(strings: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within their groups, and each place's common prefix with the place before (0 at a group's first)."""
    flat, words = words_of(strings)
    order, block = multikey(words, groups)
    sizes = np.array([len(s) for s in strings])
    before, after = order[:-1], order[1:]
    differ = flat[before] != flat[after]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), flat.shape[1])
    same = np.minimum(same, np.minimum(sizes[before], sizes[after]))
    shared = np.concatenate([[0], np.where(groups[before] == groups[after], same, 0)]).astype(np.int64)
    ends = np.flatnonzero(np.concatenate([block[1:] != block[:-1], [True]])) + 1 if len(block) else []
    start = 0
    for end in ends:
        if end - start > 1:
            members = order[start:end]
            low = int(min(flat.shape[1], sizes[members[0]]))
            found = blind_order([strings[i] for i in members], low)
            order[start:end] = members[[i for i, _ in found]]
            shared[start + 1 : end] = [n for _, n in found[1:]]
        start = end
    return order, shared
