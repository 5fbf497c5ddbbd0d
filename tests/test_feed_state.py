"""What a feed keeps of a batch."""

from collections import namedtuple

from marketlake.streaming.stateful import MINUTE, FeedAlarms


class Kept:
    """A state that a processor keeps, in memory."""

    def __init__(self):
        self.rows, self.timers = [], []

    def getListState(self, *_):
        return self

    def getValueState(self, *_):
        return Kept()

    def registerTimer(self, ms):
        self.timers.append(ms)

    def appendList(self, rows):
        self.rows += rows


def test_a_feed_keeps_the_ends_of_short_stretches_only():
    alarms, kept, row = FeedAlarms(20 * MINUTE, 15 * MINUTE), Kept(), namedtuple("row", "us")
    alarms.init(kept)
    list(alarms.handleInputRows(("f",), (row(us) for us in range(0, 60 * MINUTE, MINUTE // 100)), None))
    assert [us for (us,) in kept.rows] == [us for k in range(4) for us in (15 * k * MINUTE, 15 * (k + 1) * MINUTE - MINUTE // 100)]
    assert kept.timers == [15 * MINUTE // 1000 + 1]
