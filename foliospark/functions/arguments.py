"""Command-line arguments as parameters of a job. Read on the driver: they
configure the job and are not data."""

from __future__ import annotations

from collections.abc import Mapping

from foliospark.operators.ledger import DEFAULT_PROVIDER

#: Providers that can be named.
PROVIDERS = ("claude", "openai")


def provider_of(args: list[str], env: Mapping[str, str]) -> str:
    """The provider after ``--provider``, else of the environment, else the
    default; unknown names mean the default."""
    after = [b for a, b in zip(args, args[1:], strict=False) if a == "--provider"]
    name = (after[0] if after else env.get("PROVIDER", DEFAULT_PROVIDER)).lower()
    return name if name == PROVIDERS[1] else DEFAULT_PROVIDER


def command(args: list[str], env: Mapping[str, str], polls: bool = False) -> dict:
    """``provider, explicit, batch_id, sync`` of a command's arguments."""
    plain = [a for a in args if not a.startswith("--") and a not in PROVIDERS]
    return {"provider": provider_of(args, env), "explicit": "--provider" in args or bool(env.get("PROVIDER")), "batch_id": plain[0] if polls and plain else None, "sync": "--sync" in args}


def reextraction(args: list[str]) -> dict:
    """``json, pdf, label, page, caption, alt`` of a request for one figure."""
    given, places, k = {}, [], 0
    while k < len(args):
        if args[k].startswith("--"):
            given[args[k][2:]] = args[k + 1] if k + 1 < len(args) else None
            k += 2
        else:
            places.append(args[k])
            k += 1
    if len(places) < 3:
        raise ValueError("a record, a PDF and a figure label are needed")
    page = given.get("page")
    if "page" in given and not (page or "").isdigit() or page and int(page) <= 0:
        raise ValueError("--page must be a positive integer")
    return {"json": places[0], "pdf": places[1], "label": places[2], "page": int(page) if page else None, "caption": given.get("caption"), "alt": given.get("alt")}
