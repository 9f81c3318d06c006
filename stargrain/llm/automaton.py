"""Generalised suffix automaton of several token sequences, walked for many texts at once.

A state stands for the sequences that end at the same places of the templates.
Reading a text token by token, and falling back along suffix links where the
next token does not follow, gives its matching statistics: at each token the
longest run ending there that occurs in a template, as (state, length).

The walk is in step over all runs of known tokens of a part of text: one vector
operation reads the next token of every run. As no match is longer than the
longest template, a long run is cut into blocks that start so many tokens
early, and the results are the same.
"""

from __future__ import annotations

import numpy as np

BLOCK = 2048


class Automaton:
    """Tokens are numbers from 1 on; 0 is a token that no template has."""

    def __init__(self, templates: list[list[int]], n_tokens: int):
        moves: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def state(size: int, edges: dict[int, int], suffix: int) -> int:
            moves.append(edges)
            length.append(size)
            link.append(suffix)
            return len(moves) - 1

        def split(parent: int, token: int) -> int:
            """The state for parent's longest sequence with the token, cut from a state of longer ones if need be."""
            child = moves[parent][token]
            if length[child] == length[parent] + 1:
                return child
            copy = state(length[parent] + 1, dict(moves[child]), link[child])
            link[child] = copy
            while parent >= 0 and moves[parent].get(token) == child:
                moves[parent][token] = copy
                parent = link[parent]
            return copy

        places: list[tuple[int, int, int]] = []  # state, template, index of the token
        for number, tokens in enumerate(templates):
            last = 0
            for i, token in enumerate(tokens):
                if token in moves[last]:
                    last = split(last, token)
                else:
                    new, p = state(length[last] + 1, {}, 0), last
                    while p >= 0 and token not in moves[p]:
                        moves[p][token] = new
                        p = link[p]
                    if p >= 0:
                        link[new] = split(p, token)
                    last = new
                places.append((last, number, i))

        self.link, self.length = np.array(link), np.array(length)
        self.n_tokens = n_tokens + 1
        self.longest = max(map(len, templates), default=0)
        edges = sorted((s * self.n_tokens + t, to) for s, known in enumerate(moves) for t, to in known.items())
        self.keys = np.array([k for k, _ in edges] + [len(moves) * self.n_tokens], np.int64)
        self.targets = np.array([to for _, to in edges] + [0], np.int64)
        follow = {a * self.n_tokens + b for tokens in templates for a, b in zip(tokens, tokens[1:])}
        self.pairs = np.array(sorted(follow) + [self.n_tokens**2], np.int64)
        self._places = places

    def locate(self, tokens: list[int]) -> int:
        """The state of a sequence that occurs in a template."""
        at = 0
        for token in tokens:
            at = int(self.targets[np.searchsorted(self.keys, at * self.n_tokens + token)])
        return at

    def below(self, state: int) -> np.ndarray:
        """Per state: do all its sequences of at least ``length[state]`` tokens end with that state's?"""
        mark = np.zeros(len(self.link), bool)
        mark[state] = True
        for s in np.argsort(self.length, kind="stable"):
            mark[s] |= self.link[s] >= 0 and mark[self.link[s]]
        return mark

    def places_of(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where the last ``least`` tokens of a match stand in the templates.

        (group of each state or -1, first place of each group, template, index of the last token).
        """
        top = np.full(len(self.link), -1)
        for s in np.argsort(self.length, kind="stable"):
            if self.length[s] >= least:
                up = self.link[s]
                top[s] = top[up] if up >= 0 and self.length[up] >= least else s
        found: dict[int, list[tuple[int, int]]] = {}
        for s, number, i in self._places:
            if top[s] >= 0:
                found.setdefault(int(top[s]), []).append((number, i))
        groups = sorted(found)
        number_of = np.full(len(self.link) + 1, -1)
        number_of[groups] = np.arange(len(groups))
        flat = [p for g in groups for p in found[g]]
        first = np.cumsum([0] + [len(found[g]) for g in groups])
        return number_of[top], first, np.array([t for t, _ in flat], np.int64), np.array([i for _, i in flat], np.int64)

    def _step(self, state: np.ndarray, size: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        state, size = state.copy(), size.copy()
        open_ = np.arange(len(state))
        while len(open_):
            want = state[open_] * self.n_tokens + token[open_]
            at = np.searchsorted(self.keys, want)
            hit = self.keys[at] == want
            done = open_[hit]
            state[done] = self.targets[at[hit]]
            size[done] += 1
            open_ = open_[~hit]
            up = self.link[state[open_]]
            lost = open_[up < 0]
            state[lost] = size[lost] = 0
            open_, up = open_[up >= 0], up[up >= 0]
            state[open_] = up
            size[open_] = self.length[up]
        return state, size

    def walk(self, tokens: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics (state, length) of the texts tokens[first[t]:first[t + 1]].

        Only matches of at least ``least`` tokens are followed; elsewhere the length is 0.
        """
        n = len(tokens)
        states, sizes = np.zeros(n, np.int64), np.zeros(n, np.int64)
        joined = np.zeros(n + 1, bool)  # token i follows token i - 1 in some template
        if n > 1:
            want = tokens[:-1].astype(np.int64) * self.n_tokens + tokens[1:]
            joined[1:n] = self.pairs[np.searchsorted(self.pairs, want)] == want
        joined[first] = False
        starts = np.flatnonzero(~joined[:n] & ((least <= 1) & (tokens > 0) | joined[1:]))
        breaks = np.flatnonzero(~joined)
        lengths = breaks[np.searchsorted(breaks, starts, "right")] - starts
        starts, lengths = starts[lengths >= least], lengths[lengths >= least]
        # Blocks of long runs, each with the tokens before it that a match may still hold.
        blocks = np.maximum(1, -(-lengths // BLOCK))
        number = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(starts, blocks) + number * BLOCK
        end = np.minimum(begin + BLOCK, np.repeat(starts + lengths, blocks))
        early = np.maximum(begin - self.longest, np.repeat(starts, blocks))
        order = np.argsort(early - end, kind="stable")  # longest first
        begin, end, early = begin[order], end[order], early[order]
        steps = end - early
        state, size = np.zeros(len(steps), np.int64), np.zeros(len(steps), np.int64)
        for k in range(int(steps[0]) if len(steps) else 0):
            active = int(np.searchsorted(-steps, -k, "left"))
            at = early[:active] + k
            state[:active], size[:active] = self._step(state[:active], size[:active], tokens[at])
            own = at >= begin[:active]
            states[at[own]], sizes[at[own]] = state[:active][own], size[:active][own]
        return states, sizes
