"""Settings from arguments, a file (JSON, TOML or INI) and the environment, in this order."""

from __future__ import annotations

import configparser
import json
import os
import tomllib
from pathlib import Path


def load_config(path: str | None = None, env_prefix: str = "EOCUBE_", section: str = "default", **arguments) -> dict[str, str]:
    found: dict = {k[len(env_prefix) :].lower(): v for k, v in os.environ.items() if k.startswith(env_prefix)}
    if path:
        kind, text = Path(path).suffix.lower(), Path(path).read_text()
        if kind == ".json":
            found |= json.loads(text)
        elif kind == ".toml":
            found |= tomllib.loads(text)
        elif kind in (".ini", ".cfg"):
            parser = configparser.ConfigParser()
            parser.read_string(text)
            if section not in parser:
                raise KeyError(f"no section {section!r} in {path}")
            found |= dict(parser[section])
        else:
            raise ValueError(f"unknown kind of settings file: {path}")
    return found | {k: v for k, v in arguments.items() if v is not None}
