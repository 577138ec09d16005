"""Connection settings from the process environment and one env file."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

PREFIX = "SNOWFLAKE_"
#: The settings a run can't do without.
REQUIRED = ("ACCOUNT", "USER", "DATABASE", "SCHEMA", "WAREHOUSE", "TABLE")
OPTIONAL = ("URL", "ROLE", "KEY_PATH", "KEY_PASSPHRASE")

_LINE = re.compile(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*")


@dataclass(frozen=True)
class Settings:
    values: Mapping[str, str]

    def get(self, name: str) -> str | None:
        """A setting without its prefix; an empty one counts as absent."""
        return self.values.get(PREFIX + name) or None

    @property
    def url(self) -> str:
        return self.get("URL") or f"{self.get('ACCOUNT')}.snowflakecomputing.com"

    def reader_options(self, credentials: Mapping[str, str]) -> dict[str, str]:
        base = {"sfURL": self.url, "sfUser": self.get("USER"), "sfDatabase": self.get("DATABASE"), "sfSchema": self.get("SCHEMA"), "sfWarehouse": self.get("WAREHOUSE")}
        role = {"sfRole": self.get("ROLE")} if self.get("ROLE") else {}
        return {**base, **credentials, **role}


def parse_env(text: str) -> dict[str, str]:
    """``NAME=value`` lines; ``export`` and surrounding quotes are dropped, an unquoted `` #`` starts a comment."""
    out = {}
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if not (m := _LINE.fullmatch(line)):
            raise ValueError(f"not a NAME=value line: {line.split('=')[0]!r}")
        name, value = m.groups()
        if value[:1] in ("'", '"') and (end := value.find(value[0], 1)) > 0:
            value = value[1:end]
        else:
            value = re.split(r"(?:^|\s)#", value, maxsplit=1)[0].rstrip()
        out[name] = value
    return out


def load_settings(environ: Mapping[str, str], env_file: str | None = None) -> Settings:
    """The process environment goes before the file; every missing setting is named at once.

    ``env_file`` or else ENV_FILE names the one file that is read; without either, none is.
    """
    path = env_file or environ.get("ENV_FILE")
    values = {**(parse_env(Path(path).read_text()) if path else {}), **{k: v for k, v in environ.items() if k.startswith(PREFIX) and v}}
    settings = Settings({k: v for k, v in values.items() if k.startswith(PREFIX)})
    if missing := [PREFIX + k for k in REQUIRED if not settings.get(k)]:
        raise ValueError(f"missing settings: {', '.join(missing)}")
    return settings
