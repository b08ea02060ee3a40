"""Conditions on frames that are checked on the record headers of a recording,
before anything is built for a record."""

from __future__ import annotations

from dataclasses import dataclass, replace

ID_BITS = 4096


def id_bit(frame_id: int) -> int:
    """Place of an id in a range's bitmap of ids."""
    return (frame_id * 0x9E3779B1 & 0xFFFFFFFF) >> 20


@dataclass(frozen=True)
class FrameFilter:
    """Ids and modules to keep (None: all); first and last ts in µs."""
    ids: tuple[int, ...] | None = None
    modules: tuple[int, ...] | None = None
    ts_from: int | None = None
    ts_to: int | None = None

    @property
    def all(self) -> bool:
        return self == FrameFilter()

    def and_ids(self, ids) -> "FrameFilter":
        return replace(self, ids=tuple(ids) if self.ids is None else tuple(x for x in self.ids if x in set(ids)))

    def and_modules(self, modules) -> "FrameFilter":
        return replace(self, modules=tuple(modules) if self.modules is None else tuple(x for x in self.modules if x in set(modules)))

    def and_ts(self, low: int | None = None, high: int | None = None) -> "FrameFilter":
        lows, highs = [x for x in (self.ts_from, low) if x is not None], [x for x in (self.ts_to, high) if x is not None]
        return replace(self, ts_from=max(lows, default=None), ts_to=min(highs, default=None))

    def mask(self, buf, starts):
        """Which of the records at ``starts`` of ``buf`` (bytes as numbers) to
        build."""
        import numpy as np

        on = np.ones(len(starts), bool)

        def signed(at):
            x = sum(buf[starts + at + k].astype(np.int64) << (24 - 8 * k) for k in range(4))
            return np.where(x >= 2**31, x - 2**32, x)

        if self.ids is not None:
            on &= np.isin(signed(12), np.array(self.ids, np.int64))
        if self.modules is not None:
            port = buf[starts + 9].astype(np.int64)
            on &= np.isin(np.where(port >= 128, port - 256, port) + 1, np.array(self.modules, np.int64))
        if self.ts_from is not None or self.ts_to is not None:
            low = signed(4)
            ts = signed(0) * 1_000_000 + np.where(low >= 0, low // 1000, -((-low) // 1000))
            if self.ts_from is not None:
                on &= ts >= self.ts_from
            if self.ts_to is not None:
                on &= ts <= self.ts_to
        return on

    def may_hold(self, min_ts: int | None, max_ts: int | None, id_words: list[int] | None) -> bool:
        """Whether a range with these bounds and ids can hold a frame."""
        if min_ts is None or (self.ts_from is not None and max_ts < self.ts_from) or (self.ts_to is not None and min_ts > self.ts_to):
            return False
        return self.ids is None or any(id_words[id_bit(x) >> 6] >> (id_bit(x) & 63) & 1 for x in self.ids)
