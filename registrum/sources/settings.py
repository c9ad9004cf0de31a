"""Settings from the environment and from files of NAME=value lines."""

from __future__ import annotations

import os
import re
from collections.abc import MutableMapping


def load_env(text: str, into: MutableMapping[str, str] | None = None) -> None:
    """Adds what the lines name and the environment does not have. Comments, blank lines and quotes around values are passed over."""
    into = os.environ if into is None else into
    for line in text.splitlines():
        if m := re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line):
            value = m[2][1:-1] if len(m[2]) > 1 and m[2][0] == m[2][-1] and m[2][0] in "\"'" else m[2]
            into.setdefault(m[1], value)


def require_env(name: str, of: MutableMapping[str, str] | None = None) -> str:
    value = (os.environ if of is None else of).get(name)
    if not value:
        raise KeyError(f"{name} is not set")
    return value
