"""Ids of whole texts from the ids of their units, each different unit of some MB encoded once.

Texts are cut before single spaces and line ends that stand between solid characters (``textunits`` says
why byte-level pre-tokenisation always cuts there: the same holds for a line end, which is a match of its
own). The units of a group of texts are numbered by Arrow, and the ids of the texts are taken from a
pool by these numbers. Texts that can't be cut so at every space and line end are coded otherwise.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from caresight.llm.textunits import SOLID, spans

#: Bytes of text whose units are told apart at a time.
GROUP_BYTES = 1 << 22
#: Units (after a line end or none): of solid characters only; with such at both ends.
PLAIN, SOUND = f"^\n?[{SOLID}]+$", f"^\n?[{SOLID}](?:[^ \n]*[{SOLID}])?$"


class UnitCoder:
    """Codes texts by their units; the two ways of coding strings are its subclasses'."""

    def code_units(self, units: pa.Array, plain: np.ndarray, sound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where those of each unit begin in it and how many they are.

        A unit comes with its space or line end. Those that are not ``sound`` need no ids.
        """
        raise NotImplementedError

    def code_text(self, text: str) -> np.ndarray:
        """Ids of any text."""
        raise NotImplementedError

    def _group(self, parts: list[tuple[bool, str]]) -> list[np.ndarray]:
        """Ids of parts of texts; a part that is not its text's first follows a space."""
        # a first part gets a line end before it, whose id is taken off again
        marked = pa.array([("" if later else "\n") + t.replace("\n", " \n") for later, t in parts], pa.large_string())
        cut = pc.split_pattern(marked, " ")
        numbered = cut.values.dictionary_encode()
        units = numbered.dictionary
        plain = pc.match_substring_regex(units, PLAIN).to_numpy(zero_copy_only=False)
        sound = plain.copy()
        sound[~plain] = pc.match_substring_regex(units.filter(pa.array(~plain)), SOUND).to_numpy(zero_copy_only=False)
        led = pc.if_else(pc.starts_with(units, "\n"), units, pc.binary_join_element_wise(pa.scalar("", units.type), units, pa.scalar(" ", units.type)))
        pool, starts, sizes = self.code_units(led, plain, sound)
        which = numbered.indices.to_numpy()
        lengths = sizes[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = pool[np.repeat(starts[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        bounds = cut.offsets.to_numpy()
        strange = np.concatenate([[0], np.cumsum(~sound[which])])[bounds]
        own = ends[bounds].tolist()
        return [self.code_text(" " * later + text) if strange[k + 1] > strange[k] else ids[own[k] + (not later):own[k + 1]]
                for k, (later, text) in enumerate(parts)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        parts = [(row, n > 0, part) for row, text in enumerate(texts) for n, part in enumerate(spans(text))]
        at = 0
        while at < len(parts):
            to, size = at, 0
            while to < len(parts) and (size == 0 or size < GROUP_BYTES):
                size += len(parts[to][2]) + 1
                to += 1
            for (row, _, _), ids in zip(parts[at:to], self._group([(later, t) for _, later, t in parts[at:to]])):
                out[row].append(ids)
            at = to
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def joined(strings: pa.Array, chars: int):
    """(from, to, joined string) of the strings (large), some ``chars`` bytes each."""
    if not len(strings):
        return
    _, at, body = strings.buffers()
    at = np.frombuffer(at, np.int64)[strings.offset:strings.offset + len(strings) + 1]
    calls = np.flatnonzero(np.diff(at[:-1] // chars, prepend=-1, append=-1)).tolist()
    for a, z in zip(calls, calls[1:]):
        yield a, z, body[at[a]:at[z]].to_pybytes().decode()
