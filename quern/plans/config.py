"""Settings from YAML files and the environment."""

from __future__ import annotations

import os
from pathlib import Path

from quern.sources.files import load_yaml

STAGE_FILES = ("chunking", "generation", "cleaning", "evaluation")
#: Environment variables and the settings they replace, as paths of keys.
OVERRIDES = {
    "PIPELINE_DOMAIN_CONTEXT": ("domain_context",),
    "LOG_LEVEL": ("logging", "level"),
    "GENERATION_PROVIDER": ("generation_llm", "provider"),
    "GENERATION_MODEL": ("generation_llm", "model"),
    "JUDGE_PROVIDER": ("judge_llm", "provider"),
    "JUDGE_MODEL": ("judge_llm", "model"),
}


#: Variables of each kind of provider and the settings of a role's section that they replace.
SWITCHES = {
    "ollama": {"OLLAMA_MODE": "mode", "OLLAMA_HOST": "host", "OLLAMA_MODEL": "model", "OLLAMA_API_KEY": "api_key"},
    "gemini": {"GEMINI_MODE": "mode", "GOOGLE_API_KEY": "api_key", "GOOGLE_CLOUD_PROJECT": "project", "GOOGLE_CLOUD_LOCATION": "location"},
}


def overridden(config: dict, environment: dict[str, str] | None = None, overrides: dict[str, tuple[str, ...]] = OVERRIDES) -> dict:
    """`config` with the settings that the environment names; empty values are ignored.

    GENERATION_PROVIDER chooses the kind of the generating role, whose variables then apply; one that is switched to
    ollama takes its thinking and its time limit from the judge.  The judge's variables are those of its own kind.
    """
    env = os.environ if environment is None else environment
    out = {k: dict(v) if isinstance(v, dict) else v for k, v in config.items()}
    for name, keys in overrides.items():
        if env.get(name):
            at = out
            for k in keys[:-1]:
                at = at.setdefault(k, {})
            at[keys[-1]] = env[name].lower() if name.endswith("_PROVIDER") else env[name]
    maker, judge = out.get("generation_llm", {}), out.get("judge_llm", {})
    for section in (maker, judge):
        for name, key in SWITCHES.get(section.get("provider", ""), {}).items():
            if env.get(name):
                section[key] = env[name]
    if env.get("GENERATION_PROVIDER", "").lower() == "ollama":
        maker.setdefault("mode", "local")
        maker["model"] = env.get("OLLAMA_GENERATION_MODEL") or env.get("OLLAMA_MODEL") or maker.get("model", "qwen3")
        maker |= {"think": judge.get("think", False), "timeout_seconds": judge.get("timeout_seconds", 600)}
    return out


def load_all(folder: str, environment: dict[str, str] | None = None) -> dict:
    """pipeline.yaml with the files of the stages under their names, and the environment's settings."""
    config = load_yaml(str(Path(folder) / "pipeline.yaml"))
    for name in STAGE_FILES:
        path = Path(folder) / f"{name}.yaml"
        config[name] = load_yaml(str(path)) if path.exists() else {}
    return overridden(config, environment)
