"""The log of a run's look-ups: tallies in the driver, a detail file per run, and a history that runs append to under a lock."""

from __future__ import annotations

import csv
import fcntl
import getpass
import socket
from collections import Counter
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import Path

from .prices import SERVICES

META = ("run_id", "started_at", "finished_at", "status", "state", "host", "user")
DETAIL = ("api", "caller", "requests", "succeeded", "failed", "failure_codes", "usd_per_1000", "free_per_month", "est_cost_list_usd")
HISTORY = ("api", "requests", "succeeded", "failed", "usd_per_1000", "est_cost_list_usd", "free_per_month", "month_to_date_requests", "est_cost_after_free_usd")


def failure_text(codes: Counter) -> str:
    """``code: n; ...``, the most frequent first."""
    return "; ".join(f"{code}: {n}" for code, n in sorted(codes.items(), key=lambda x: (-x[1], str(x[0]))))


def billable(n: int, before: int, free: int) -> int:
    return max(before + n - free, 0) - max(before - free, 0)


@dataclass
class RunLog:
    """Look-ups of one run by service and caller."""

    state: str = ""
    started_at: datetime = field(default_factory=datetime.now)
    calls: dict[tuple[str, str], list] = field(default_factory=dict)

    @property
    def run_id(self) -> str:
        return self.started_at.strftime("%Y%m%d_%H%M%S")

    def add(self, api: str, caller: str, requests: int, succeeded: int, codes: Counter | None = None) -> None:
        tally = self.calls.setdefault((api, caller), [0, 0, Counter()])
        tally[0] += requests
        tally[1] += succeeded
        tally[2].update(codes or {})

    def rows(self, by_caller: bool = False) -> list[dict]:
        prices = {api: (usd, free) for api, usd, free, _ in SERVICES}
        grouped: dict[tuple, list] = {}
        for (api, caller), (n, good, codes) in self.calls.items():
            tally = grouped.setdefault((api, caller if by_caller else None), [0, 0, Counter()])
            tally[0] += n
            tally[1] += good
            tally[2].update(codes)
        out = []
        for (api, caller), (n, good, codes) in sorted(grouped.items(), key=lambda x: (x[0][0], x[0][1] or "")):
            usd, free = prices.get(api, (0.0, 0))
            out.append({"api": api, "caller": caller, "requests": n, "succeeded": good, "failed": n - good, "failure_codes": failure_text(codes), "usd_per_1000": usd, "free_per_month": free, "est_cost_list_usd": round(n * usd / 1000, 2)})
        return out

    def write(self, folder: str, status: str = "completed", finished_at: datetime | None = None) -> str:
        """Writes the run's detail file, appends to the history, and gives the detail file's path.

        A run without calls leaves one row of zeros in its detail file and nothing in the history.
        """
        target = Path(folder)
        target.mkdir(parents=True, exist_ok=True)
        meta = dict(zip(META, (self.run_id, f"{self.started_at:%Y-%m-%d %H:%M:%S}", f"{finished_at or datetime.now():%Y-%m-%d %H:%M:%S}", status, self.state, socket.gethostname(), getpass.getuser())))
        detail = self.rows(by_caller=True) or [dict.fromkeys(DETAIL, 0) | {"api": "", "caller": "", "failure_codes": ""}]
        path = target / f"api_calls_{self.state or 'all'}_{self.run_id}.csv"
        self._save(path, [meta | r for r in detail], (*META, *DETAIL), "w")
        history = target / "api_calls_all_runs.csv"
        with (target / "api_calls_all_runs.lock").open("w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            prior: Counter = Counter()
            if history.exists():
                with history.open(newline="") as f:
                    for row in csv.DictReader(f):
                        if row["started_at"][:7] == meta["started_at"][:7]:
                            prior[row["api"]] += int(row["requests"])
            rows = []
            for r in self.rows():
                before = prior[r["api"]]
                paid = billable(r["requests"], before, r["free_per_month"])
                rows.append(meta | r | {"month_to_date_requests": before + r["requests"], "est_cost_after_free_usd": round(paid * r["usd_per_1000"] / 1000, 2)})
            if rows:
                self._save(history, rows, (*META, *HISTORY), "a")
        return str(path)

    @staticmethod
    def _save(path: Path, rows: list[dict], columns: tuple[str, ...], mode: str) -> None:
        new = mode == "w" or not path.exists()
        with path.open(mode, newline="") as f:
            out = csv.DictWriter(f, columns, extrasaction="ignore")
            if new:
                out.writeheader()
            out.writerows(rows)
