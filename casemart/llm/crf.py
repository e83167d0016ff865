"""Linear-chain conditional random fields in numpy: marginals of many chains at once, and training.

All chains of a batch are laid end to end; the first item of a chain forgets what came before. The
recursion runs over blocks of `BLOCK` items side by side: products of transition matrices carry
the state over a block, so a long chain costs no more than many short ones. For many labels, whose
products would cost the cube of their number, the recursion takes the items one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

BLOCK = 64
WIDE = 32  # labels; above it a product of matrices costs more than a step for each item
MATRIX_CELLS = 1 << 21  # of the blocks' matrices held at a time in prediction
PAIR_CELLS = 1 << 22  # pairs of labels of neighbouring items held at a time


def _blocks(scores: np.ndarray, first: np.ndarray, moves: np.ndarray, opening: np.ndarray):
    """Weights of all items, the matrix of each place in all blocks, and the blocks' products."""
    n, k = scores.shape
    blocks = -(-n // BLOCK)
    weight = np.ones((blocks * BLOCK, k))
    weight[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    weight = weight.reshape(blocks, BLOCK, k)
    begins = np.zeros(blocks * BLOCK, dtype=bool)
    begins[:n] = first
    begins = begins.reshape(blocks, BLOCK)
    step = np.exp(moves)
    reset = np.broadcast_to(np.exp(opening), (k, k))
    filled = n - (blocks - 1) * BLOCK  # items of the last block: what fills it up changes no state

    def matrix(j: int) -> np.ndarray:
        out = np.where(begins[:, j, None, None], reset, step) * weight[:, j, None, :]
        if j >= filled:
            out[-1] = np.eye(k)
        return out

    product = np.broadcast_to(np.eye(k), (blocks, k, k))
    for j in range(BLOCK):
        product = product @ matrix(j)
        product = product / product.max(axis=(1, 2), keepdims=True)
    return weight, matrix, product


def _item_by_item(scores, first, moves, opening, before, after=None):
    """`_sweep` without products of matrices; with `after` None the forward states alone."""
    n, k = scores.shape
    weight = np.exp(scores - scores.max(axis=1, keepdims=True))
    step, reset = np.exp(moves), np.exp(opening)
    forward, state = np.empty((n, k)), before
    for i in range(n):
        state = (reset if first[i] else state @ step) * weight[i]
        state = state / state.sum()
        forward[i] = state
    if after is None:
        return weight, forward, None, None
    backward, state = np.empty((n, k)), after
    for i in range(n - 1, -1, -1):
        backward[i] = state
        state = np.ones(k) if first[i] else step @ (weight[i] * state)
        state = state / state.sum()
    return weight, forward, backward, state


def _sweep(scores, first, moves, opening, before=None, after=None):
    """Weights, forward and backward states of all items, and the backward state ahead of them."""
    n, k = scores.shape
    if k > WIDE:
        even = np.ones(k) / k
        return _item_by_item(
            scores, first, moves, opening,
            even if before is None else before, even if after is None else after,
        )
    weight, matrix, product = _blocks(scores, first, moves, opening)
    blocks = len(product)
    enter, leave = np.ones((blocks, k)) / k, np.ones((blocks, k)) / k
    if before is not None:
        enter[0] = before
    if after is not None:
        leave[-1] = after
    for c in range(1, blocks):
        state = enter[c - 1] @ product[c - 1]
        enter[c] = state / state.sum()
    for c in range(blocks - 2, -1, -1):
        state = product[c + 1] @ leave[c + 1]
        leave[c] = state / state.sum()
    forward = np.empty((blocks, BLOCK, k))
    backward = np.empty((blocks, BLOCK, k))
    state = enter
    for j in range(BLOCK):
        state = (state[:, None, :] @ matrix(j))[:, 0]
        state = state / state.sum(axis=1, keepdims=True)
        forward[:, j] = state
    state = leave
    for j in range(BLOCK - 1, -1, -1):
        backward[:, j] = state
        state = (matrix(j) @ state[:, :, None])[:, :, 0]
        state = state / state.sum(axis=1, keepdims=True)
    forward, backward = forward.reshape(-1, k)[:n], backward.reshape(-1, k)[:n]
    return weight.reshape(-1, k)[:n], forward, backward, state[0]


def _marginals(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    out = forward * backward
    out /= out.sum(axis=1, keepdims=True)
    return out


def piece_items(labels: int) -> int:
    """How many items make a piece, so that what is held of it stays within `MATRIX_CELLS`."""
    if labels > WIDE:
        return max(BLOCK, MATRIX_CELLS // labels)
    return BLOCK * max(1, MATRIX_CELLS // labels**2)


def marginals_in_pieces(
    piece: Callable[[int], tuple[np.ndarray, np.ndarray]],
    count: int,
    moves: np.ndarray,
    opening: np.ndarray,
) -> Iterator[tuple[int, np.ndarray]]:
    """(number, label marginals) of each piece of a row of items, the last piece first.

    `piece(i)` gives the scores and the chain starts of one piece; it is asked twice. Between
    pieces only one state each is kept, so memory is that of a single piece.
    """
    k = len(opening)
    state = np.ones(k) / k
    before = [state]
    for i in range(count - 1):
        scores, first = piece(i)
        if len(scores) and k > WIDE:
            state = _item_by_item(scores, first, moves, opening, state)[1][-1]
        elif len(scores):
            for product in _blocks(scores, first, moves, opening)[2]:
                state = state @ product
                state = state / state.sum()
        before.append(state)
    after = np.ones(k) / k
    for i in range(count - 1, -1, -1):
        scores, first = piece(i)
        if not len(scores):
            yield i, scores
            continue
        _, forward, backward, after = _sweep(scores, first, moves, opening, before[i], after)
        yield i, _marginals(forward, backward)


def chain_marginals(
    scores: np.ndarray,
    first: np.ndarray,
    moves: np.ndarray,
    opening: np.ndarray,
    pairs: bool = True,
) -> tuple[np.ndarray, np.ndarray | None]:
    """Forward-backward: label marginals of every item, and expected moves summed over all items.

    The moves are needed in training only; without `pairs` they are not made.

    scores: log scores, items x labels; first: where chains begin; moves, opening: log scores of
    label pairs and of a chain's first label.
    """
    n, k = scores.shape
    if not n:
        return scores, np.zeros((k, k))
    weight, forward, backward, _ = _sweep(scores, first, moves, opening)
    marginals = _marginals(forward, backward)
    if not pairs:
        return marginals, None
    step = np.exp(moves)
    inner = np.flatnonzero(~first[1:])
    after = weight[1:] * backward[1:]
    expected = np.zeros((k, k))
    for at in np.array_split(inner, -(-len(inner) * k * k // PAIR_CELLS) or 1):
        some = forward[at, :, None] * step * after[at, None, :]
        some /= np.maximum(some.sum(axis=(1, 2), keepdims=True), 1e-300)
        expected += some.sum(axis=0)
    return marginals, expected


class Adam:
    """Adam steps for a list of arrays, upwards."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.turn = arrays, rate, 0
        self.mean = [np.zeros_like(a) for a in arrays]
        self.square = [np.zeros_like(a) for a in arrays]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.turn += 1
        for a, g, m, s in zip(self.arrays, gradients, self.mean, self.square):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            up = m / (1 - 0.9**self.turn)
            a += self.rate * up / (np.sqrt(s / (1 - 0.99**self.turn)) + 1e-8)


def observed_moves(labels: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    inner = ~first[1:]
    pairs = labels[:-1][inner] * k + labels[1:][inner]
    return np.bincount(pairs, minlength=k * k).reshape(k, k).astype(float)
