"""What the stream of settled rewards costs: calls to the state, each a round trip."""

import datetime as dt
from types import SimpleNamespace

from lodestride.streaming.rewards import DAY_MS, EPOCH, PendingRewards


class Counted:
    """A handle and its value state; every call but the set-up counts."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


def test_calls_do_not_grow_with_rows_and_days():
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    row = lambda n, decision: SimpleNamespace(day=day(n), is_decision=decision, decided_at=n, chosen_arm=n % 5, reward=float(n))
    handle = Counted()
    state = PendingRewards(10)
    state.init(handle)
    assert list(state.handleInputRows((7,), iter([row(n, k) for n in range(100) for k in (True, False)]), None)) == []
    assert handle.timers == {(day(0) - EPOCH).days * DAY_MS}
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: (day(99) - EPOCH).days * DAY_MS)
    out = list(state.handleExpiredTimer((7,), now, None))
    assert [(r.decision_date, r.reward_session_date) for r in out] == [(day(n), day(n + 1)) for n in range(99)]
    assert handle.calls <= 6 and max(handle.timers) == (day(109) - EPOCH).days * DAY_MS
