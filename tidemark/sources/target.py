"""Where tables live: on this machine unless a remote store is asked for in so many words."""

from __future__ import annotations

from collections.abc import Mapping


def warehouse_uri(environment: Mapping[str, str], local: str, remote: str | None = None, credentials: tuple[str, ...] = ()) -> str:
    """The local folder; the remote one only if TIDEMARK_REMOTE is 1, and then with every credential present.

    Credentials that merely happen to be there change nothing, so that a local run never writes to a shared store.
    """
    if environment.get("TIDEMARK_REMOTE") != "1":
        return local
    missing = [name for name in credentials if not environment.get(name)]
    if remote is None or missing:
        raise RuntimeError(f"a remote warehouse is asked for, but these are missing: {', '.join(missing) or 'its address'}")
    return remote
