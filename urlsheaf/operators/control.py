"""Concurrency advice per host: a five-state policy over interval rows.

``advance`` is the pure step from one interval to the next.  The batch form
folds it over each host's intervals in time order; the streaming form keeps
the same state in the state store.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.operators.signals import ALPHA, DEFAULT_RTPROP, GOODPUT_HISTORY

INIT, STARTUP, PROBE_BW, PROBE_RTT, BACKOFF = "INIT", "STARTUP", "PROBE_BW", "PROBE_RTT", "BACKOFF"

ADVICE = (
    "host string, interval_start timestamp, interval_end timestamp, state string, concurrency int, "
    "ceiling int, reason string, rtprop double, p10 double, p50 double, p95 double"
)
INPUT = [
    "host",
    "interval_start",
    "interval_end",
    "total",
    "n_samples",
    "has_overload",
    "goodput_rps",
    "retry_after",
    "p10_raw",
    "p50_raw",
    "p95_raw",
]


@dataclass(frozen=True)
class Policy:
    """The defaults of the control policy."""

    c_init: int = 4
    c_min: int = 2
    c_max: int = 10_000
    init_samples: int = 100
    startup_theta_50: float = 3.0
    startup_theta_95: float = 4.0
    startup_step: int = 30
    efficiency_window: int = 5
    efficiency_threshold: float = 0.5
    plateau: str = "latency"
    mu: float = 0.85
    steady_step: int = 10
    theta_50: float = 1.5
    theta_95: float = 2.0
    probe_period: float = 10.0
    probe_samples: int = 100
    probe_factor: float = 0.5
    beta: float = 0.5
    cooldown_rtprops: float = 5.0
    cooldown_floor: float = 2.0
    recut_rtprops: float = 10.0
    recut_floor: float = 3.0
    underperformance: float = 0.5
    underperformance_runs: int = 5
    revision: float = 0.99
    alpha: float = ALPHA
    rtprop_window: float = 35.0
    # variants: grow by a share, cut by one at first, keep concurrency on recovery
    steady_share: float = 0.0
    startup_cut_one: bool = False
    keep_on_recovery: bool = False

    def clamp(self, c: int) -> int:
        return min(max(c, self.c_min), self.c_max)

    def shrink(self, c: int) -> int:
        return max(self.c_min, int(c * self.beta))

    def first_cut(self, c: int) -> int:
        return max(self.c_min, c - 1) if self.startup_cut_one else self.shrink(c)

    def steady_growth(self, c: int) -> int:
        return max(1, int(c * self.steady_share)) if self.steady_share else self.steady_step


# The variant for thread pools.
THREADED = Policy(startup_step=10, steady_share=0.02, startup_cut_one=True, keep_on_recovery=True)


@dataclass
class Host:
    """Everything the policy remembers about one host."""

    state: str = INIT
    c: int = 0
    ceiling: int | None = None
    operating: int = 0
    samples: int = 0
    since_probe: int = 0
    last_probe: float = 0.0
    last_cut: float = 0.0
    cool_until: float = 0.0
    saved: int | None = None
    restoring: bool = False
    streak: int = 0
    rtprop: float | None = None
    window: list = field(default_factory=list)
    smooth: dict = field(default_factory=dict)
    goodput: list = field(default_factory=list)

    @classmethod
    def fresh(cls, policy: Policy) -> Host:
        start = policy.clamp(policy.c_init)
        return cls(c=start, operating=policy.c_init)

    def dump(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def load(cls, text: str) -> Host:
        return cls(**json.loads(text))


def _absorb(h: Host, seen: dict, now: float, policy: Policy) -> None:
    """Take in latency and goodput of the interval."""
    for name in ("p10", "p50", "p95"):
        raw = seen[f"{name}_raw"]
        if raw is not None:
            old = h.smooth.get(name)
            h.smooth[name] = raw if old is None else old + policy.alpha * (raw - old)
    low = seen["p10_raw"]
    if low is not None:
        h.window = [s for s in h.window if s[0] >= now - policy.rtprop_window]
        # busy phases inflate latency, so there only a new minimum counts
        trusted = h.state == INIT or (h.state == PROBE_RTT and h.restoring)
        if trusted or h.rtprop is None or low < h.rtprop:
            h.window.append([now, low])
        if h.window:
            h.rtprop = min(s[1] for s in h.window)
    h.goodput = (h.goodput + [seen["goodput_rps"]])[-GOODPUT_HISTORY:]
    h.since_probe += seen["n_samples"]


def _slow(h: Host, theta_50: float, theta_95: float) -> bool:
    if h.rtprop is None:
        return False
    limits = {"p50": h.rtprop * theta_50, "p95": h.rtprop * theta_95}
    return any(h.smooth.get(name) is not None and h.smooth[name] > at for name, at in limits.items())


def _flat(h: Host, policy: Policy) -> bool:
    steps = policy.efficiency_window
    if len(h.goodput) <= steps or h.c <= steps:
        return False
    past, current = h.goodput[-steps - 1], h.goodput[-1]
    proportional = past / (h.c - steps)
    return past > 0 and (current - past) / steps < proportional * policy.efficiency_threshold


def _cool(h: Host, seen: dict, now: float, policy: Policy) -> None:
    rest = max(policy.cooldown_rtprops * _latency(h), policy.cooldown_floor, seen["retry_after"] or 0.0)
    h.cool_until, h.last_cut = now + rest, now


def _latency(h: Host) -> float:
    return DEFAULT_RTPROP if h.rtprop is None else h.rtprop


def _steady(h: Host, now: float) -> None:
    h.state, h.last_probe, h.since_probe = PROBE_BW, now, 0


def _operate(h: Host, policy: Policy, ceiling: int) -> None:
    """Adopt a ceiling and run at its working share."""
    h.ceiling, h.operating = ceiling, int(ceiling * policy.mu)
    h.c = policy.clamp(h.operating)


def _in_init(h: Host, seen: dict, now: float, policy: Policy) -> str:
    h.samples += seen["n_samples"]
    if seen["has_overload"]:
        h.ceiling, h.state = policy.c_init, BACKOFF
        _cool(h, seen, now, policy)
        return "overload"
    if h.samples < policy.init_samples:
        return "sampling"
    h.state, h.goodput = STARTUP, []
    return "sampled"


def _in_startup(h: Host, seen: dict, now: float, policy: Policy) -> str:
    if seen["has_overload"]:
        _operate(h, policy, policy.first_cut(h.c))
        _cool(h, seen, now, policy)
        h.state = BACKOFF
        return "overload"
    if policy.plateau == "latency":
        full = _slow(h, policy.startup_theta_50, policy.startup_theta_95)
    else:
        full = _flat(h, policy)
    if full or h.c >= policy.c_max:
        _operate(h, policy, h.c if full else policy.c_max)
        _steady(h, now)
        return "plateau" if full else "maximum"
    h.c = policy.clamp(h.c + policy.startup_step)
    return "grow"


def _in_probe_bw(h: Host, seen: dict, now: float, policy: Policy) -> str:
    if seen["has_overload"]:
        if h.ceiling is not None:
            _operate(h, policy, policy.shrink(h.ceiling))
        else:
            h.operating = policy.shrink(h.c)
            h.c = policy.clamp(h.operating)
        _cool(h, seen, now, policy)
        h.state = BACKOFF
        return "overload"
    if now - h.last_probe > policy.probe_period and h.since_probe > policy.probe_samples:
        h.saved = h.c
        h.c = policy.clamp(int(h.c * policy.probe_factor))
        h.state = PROBE_RTT
        return "probe"
    if _slow(h, policy.theta_50, policy.theta_95):
        return "degraded"
    if h.ceiling is not None and h.c > h.ceiling:
        h.ceiling, h.operating = h.c, int(h.c * policy.mu)
    reason = "revised" if _underperforms(h, seen, policy) else "grow"
    if h.c < policy.c_max:
        h.c = policy.clamp(h.c + policy.steady_growth(h.c))
    return reason


def _underperforms(h: Host, seen: dict, policy: Policy) -> bool:
    """Lower the ceiling after a run of intervals far below expectation."""
    if h.ceiling is None or seen["goodput_rps"] < 1.0:
        return False
    if seen["goodput_rps"] >= h.operating / _latency(h) * policy.underperformance:
        h.streak = 0
        return False
    h.streak += 1
    if h.streak < policy.underperformance_runs:
        return False
    lowered = min(int(h.ceiling * policy.revision), h.ceiling - 1)
    _operate(h, policy, max(policy.c_min, lowered))
    h.streak = 0
    return True


def _in_probe_rtt(h: Host, seen: dict, now: float, policy: Policy) -> str:
    if seen["has_overload"]:
        # concurrency, the saved target and the restoring mark stay as they are
        if h.ceiling is not None:
            h.ceiling = policy.shrink(h.ceiling)
            h.operating = int(h.ceiling * policy.mu)
        _cool(h, seen, now, policy)
        h.state = BACKOFF
        return "overload"
    if not h.restoring:
        h.restoring = True
        return "settle"
    if h.saved is None:
        h.saved = h.operating
    if h.c < h.saved:
        h.c = policy.clamp(min(h.c + max(1, (h.saved - h.c) // 2), h.saved))
        return "restore"
    _steady(h, now)
    h.restoring, h.saved = False, None
    return "restored"


def _in_backoff(h: Host, seen: dict, now: float, policy: Policy) -> str:
    wait = max(policy.recut_floor, policy.recut_rtprops * _latency(h))
    if seen["has_overload"] and now - h.last_cut >= wait:
        h.c = policy.shrink(h.c)
        if h.ceiling is not None:
            h.ceiling = policy.shrink(h.ceiling)
        _cool(h, seen, now, policy)
        return "overload"
    if now < h.cool_until:
        return "cooling"
    if not policy.keep_on_recovery:
        if h.ceiling is not None:
            h.operating = int(h.ceiling * policy.mu)
        h.c = policy.clamp(h.operating)
    _steady(h, now)
    return "recovered"


_RULES: dict[str, Callable[[Host, dict, float, Policy], str]] = {
    INIT: _in_init,
    STARTUP: _in_startup,
    PROBE_BW: _in_probe_bw,
    PROBE_RTT: _in_probe_rtt,
    BACKOFF: _in_backoff,
}


def advance(h: Host, seen: dict, now: float, policy: Policy) -> str:
    """Move ``h`` over one interval that ends at ``now``; gives the reason."""
    _absorb(h, seen, now, policy)
    if seen["total"] == 0:
        return "idle"
    return _RULES[h.state](h, seen, now, policy)


def _plain(row: dict) -> dict:
    """Nulls of pandas as None."""
    return {k: None if pd.isna(v) else v for k, v in row.items()}


def fold(h: Host, pdf: pd.DataFrame, policy: Policy) -> pd.DataFrame:
    """Advance over the rows of one host in time order; one advice per row."""
    advice = []
    for row in pdf.to_dict("records"):
        seen = _plain(row)
        reason = advance(h, seen, seen["interval_end"].timestamp(), policy)
        advice.append(
            (
                seen["host"],
                seen["interval_start"],
                seen["interval_end"],
                h.state,
                h.c,
                h.ceiling,
                reason,
                h.rtprop,
                h.smooth.get("p10"),
                h.smooth.get("p50"),
                h.smooth.get("p95"),
            )
        )
    names = [c.split()[0] for c in ADVICE.split(", ")]
    frame = pd.DataFrame(advice, columns=names)
    frame["ceiling"] = frame["ceiling"].astype("Int32")
    return frame


def recommend_concurrency(metrics: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Advice per host and interval from ``interval_snapshot`` rows.

    A host's rows come in time order, batch by batch; only its state is held.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = Host.fresh(policy)
        for pdf in batches:
            yield fold(h, pdf, policy)

    ordered = metrics.select(*INPUT).repartition("host").sortWithinPartitions("host", "interval_start")
    return ordered.groupBy("host").applyInPandas(run, ADVICE)


def with_host_caps(requests: DataFrame, advice: DataFrame) -> DataFrame:
    """Requests with ``host_cap``, the latest advised concurrency of their host.

    Hosts without advice keep a null cap, and the transport's own one applies.
    """
    latest = advice.groupBy("host").agg(F.max_by("concurrency", "interval_start").alias("host_cap"))
    return requests.join(latest, "host", "left")
