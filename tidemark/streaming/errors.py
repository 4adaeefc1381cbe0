"""Which failures of a write are worth another try, how often and after how long."""

from __future__ import annotations

import time
from collections.abc import Callable

# Tries of a record, and seconds before the second one.
MAX_GENERATIONS, BACKOFF = 3, 5.0
MOST_BACKOFF = 60.0

#: Failures of a store that another try doesn't change.
LASTING = (PermissionError, FileNotFoundError, FileExistsError, IsADirectoryError, NotADirectoryError)


def retriable(error: BaseException) -> bool:
    """Input and output that broke off, time-outs and lost connections may go well next time; wrong values and lasting failures of a store won't."""
    return isinstance(error, (OSError, TimeoutError, ConnectionError)) and not isinstance(error, LASTING)


def category(error: BaseException, in_region: bool = False, has_status: bool = True) -> str:
    """RECOVER or FINAL. In a region without a status stream everything is recovered."""
    return "RECOVER" if retriable(error) or (in_region and not has_status) else "FINAL"


def recover(action: Callable, most: int = MAX_GENERATIONS, backoff: float = BACKOFF, in_region: bool = False, has_status: bool = True, sleep: Callable[[float], None] = time.sleep, failed: Callable[[BaseException], None] | None = None):
    """What ``action`` returns. It is tried again, each time after twice the time, while its failure can be recovered and ``most`` tries haven't failed.

    failed: told of every failure.
    """
    for k in range(max(most, 1)):
        try:
            return action()
        except Exception as e:
            if failed:
                failed(e)
            if k + 1 >= most or category(e, in_region, has_status) == "FINAL":
                raise
            sleep(min(backoff * 2**k, MOST_BACKOFF))
