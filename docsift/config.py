"""Configuration: five sections, file and command line over defaults, all errors at once; run ids."""

from __future__ import annotations

import json
import secrets
from dataclasses import asdict, dataclass, field, fields
from datetime import datetime, timezone
from pathlib import Path
from typing import Any


@dataclass
class Crawl:
    payer_csv: str = "payer_seed_list.csv"
    payer_range: str = "all"
    max_docs_per_payer: int = 50
    max_index_pages: int = 25
    max_enumeration_candidates: int = 20
    requests_per_second: float = 1.0
    retry_limit: int = 2
    backoff_strategy: str = "exponential"
    backoff_base_seconds: float = 1.0
    timeout_seconds: float = 30.0
    max_download_mb: float = 40.0
    user_agent: str = "docsift/0.1"
    allowed_extra_hosts: list[str] = field(default_factory=list)


@dataclass
class Logging:
    log_dir: str = "logs"
    log_level: str = "INFO"


@dataclass
class Output:
    output_dir: str = "output"
    output_format: str = "csv"
    also_xlsx: bool = False
    strict_schema: bool = False
    save_documents: bool = True


@dataclass
class Email:
    enabled: bool = False
    recipient: str = ""
    smtp_host: str = ""
    smtp_port: int = 587


@dataclass
class Resume:
    enabled: bool = True
    state_path: str = "state"
    reset: bool = False


@dataclass
class Config:
    crawl: Crawl = field(default_factory=Crawl)
    logging: Logging = field(default_factory=Logging)
    output: Output = field(default_factory=Output)
    email: Email = field(default_factory=Email)
    resume: Resume = field(default_factory=Resume)

    def to_dict(self) -> dict[str, Any]:
        return asdict(self)


def load_file(path: str | None) -> dict[str, Any]:
    if not path:
        return {}
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        import yaml

        return yaml.safe_load(text) or {}
    return json.loads(text)


def coerced(value: Any, example: Any) -> Any:
    """value as the type of the default; texts such as yes, 3 or a,b are read."""
    if isinstance(example, bool):
        text = str(value).strip().lower()
        if text not in ("true", "yes", "on", "1", "false", "no", "off", "0"):
            raise ValueError(f"{value!r} is not a yes or no")
        return text in ("true", "yes", "on", "1")
    if isinstance(example, list):
        return [x.strip() for x in value.replace("|", ",").split(",") if x.strip()] if isinstance(value, str) else list(value or [])
    return type(example)(value)


def build(file: dict[str, Any] | None = None, overrides: dict[str, dict[str, Any]] | None = None) -> Config:
    """Defaults, then the file, then overrides; unknown names and bad values are reported together."""
    config, errors = Config(), []
    for layer in (file or {}, overrides or {}):
        for section, values in layer.items():
            part = getattr(config, section, None)
            if part is None or not isinstance(values, dict):
                errors.append(f"unknown section {section!r}")
                continue
            known = {f.name for f in fields(part)}
            for name, value in values.items():
                if name not in known:
                    errors.append(f"unknown setting {section}.{name}")
                    continue
                try:
                    setattr(part, name, coerced(value, getattr(part, name)))
                except (TypeError, ValueError) as e:
                    errors.append(f"{section}.{name}: {e}")
    errors += problems(config)
    if errors:
        raise ValueError("; ".join(errors))
    return config


def problems(config: Config) -> list[str]:
    c, out = config.crawl, []
    for name, low in (("max_docs_per_payer", 1), ("max_index_pages", 1), ("max_enumeration_candidates", 0), ("retry_limit", 0)):
        if getattr(c, name) < low:
            out.append(f"crawl.{name} must be {low} or more")
    for name in ("requests_per_second", "timeout_seconds", "max_download_mb"):
        if getattr(c, name) <= 0:
            out.append(f"crawl.{name} must be above 0")
    if c.backoff_strategy not in ("exponential", "fixed"):
        out.append("crawl.backoff_strategy must be exponential or fixed")
    if config.output.output_format not in ("csv", "xlsx"):
        out.append("output.output_format must be csv or xlsx")
    if config.logging.log_level.upper() not in ("DEBUG", "INFO", "WARNING", "WARN", "ERROR"):
        out.append("logging.log_level is not a level")
    if config.email.enabled and not (config.email.recipient and config.email.smtp_host):
        out.append("email needs a recipient and a host")
    return out


def new_run_id(now: datetime | None = None) -> str:
    return f"{(now or datetime.now(timezone.utc)).strftime('%Y%m%dT%H%M%SZ')}-{secrets.token_hex(3)}"


def exit_code(interrupted: bool, strict_problems: bool, rows: int) -> int:
    return 130 if interrupted else 1 if strict_problems else 2 if not rows else 0
