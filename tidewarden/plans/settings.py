"""Settings in YAML: interpolation, overrides from the command line, validation, and their typed form."""

from __future__ import annotations

import argparse
import os
import re
import sys
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import Path

from ..functions.durations import to_micros
from ..operators.dependent import Rule


def reformat_date(text: str, in_format: str = "%Y-%m-%d %H:%M", out_format: str = "%Y%m%d") -> str:
    return datetime.strptime(text, in_format).strftime(out_format)


def _lookup(tree: dict, path: str):
    for part in path.split("."):
        tree = tree[int(part)] if isinstance(tree, list) else tree[part]
    return tree


def resolve(tree: dict) -> dict:
    """Replace ${a.b} by other settings, ${env:NAME,default} by the environment, ${date:text,in,out} by a reformatted date."""
    innermost = re.compile(r"\$\{([^${}]*)\}")

    def one(expr: str):
        name, _, rest = expr.partition(":")
        if name in ("env", "oc.env"):
            var, _, default = rest.partition(",")
            return os.environ.get(var.strip(), default.strip().strip("\"'"))
        if name in ("date", "datetime_to_date"):
            return reformat_date(*[p.strip() for p in rest.split(",")])
        return value(_lookup(tree, expr.strip()))

    def value(x):
        if isinstance(x, dict):
            return {k: value(v) for k, v in x.items()}
        if isinstance(x, list):
            return [value(v) for v in x]
        for _ in range(20):
            if not isinstance(x, str) or not (m := innermost.search(x)):
                return x
            new = one(m[1])
            x = new if m[0] == x else x[: m.start()] + str(new) + x[m.end() :]
        raise ValueError(f"settings refer to each other in a circle: {x}")

    return value(tree)


def override(tree: dict, changes: list[str]) -> dict:
    """Set a.b=value for each change."""
    import yaml

    for change in changes:
        path, _, text = change.partition("=")
        *parents, last = path.split(".")
        at = tree
        for p in parents:
            at = at.setdefault(p, {})
        at[last] = yaml.safe_load(text)
    return tree


NUMBER, BOOL, TEXT, DURATION, PAIR, IDS, URL, LIST, MAP = "number", "true or false", "text", "duration", "two numbers", "ids", "URL", "list", "map"
_range = {"range": PAIR, "gradient": PAIR, "zscore": PAIR}
#: name -> kind, or a map of names, or a list with the one kind of its items.
SHAPE = {
    "time": {"format": TEXT, "start": TEXT, "end": TEXT, "date": {"format": TEXT}},
    "hydra": MAP,
    "data_api": {"base_url": URL, "dry_run": BOOL, "auth": MAP, "things": {"id": NUMBER}, "datastreams": MAP, "observations": MAP, "filter": {"phenomenonTime": {"format": TEXT, "range": LIST}, "Datastreams": {"ids": LIST}}},
    "reset": {"overwrite_flags": BOOL, "overwrite_feature_flags": BOOL, "observation_flags": BOOL, "feature_flags": BOOL, "exit": BOOL},
    "other": MAP,
    "location": {"connection": MAP, "crs": TEXT, "time_window": DURATION, "max_dx_dt": NUMBER, "max_ddx_dtdt": NUMBER},
    "places": {"regions": TEXT, "land": TEXT, "grid": TEXT, "grid_step": NUMBER, "max_elevation": NUMBER},
    "QC_dependent": [{"independent": NUMBER, "dependent": IDS, "dt_tolerance": DURATION, "dt_stabilization": DURATION, "max_allowed_downtime": DURATION, "QC": _range}],
    "QC": [{"id": NUMBER} | _range],
    "QC_global": {"zscore": {"time_window": DURATION, "range": PAIR}, "range": {"range": PAIR}, "gradient": {"range": PAIR}},
}


def _fits(kind: str, x) -> bool:
    number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool)
    if kind == DURATION:
        try:
            to_micros(x)
            return True
        except (ValueError, TypeError):
            return False
    return {
        NUMBER: number(x), BOOL: isinstance(x, bool), TEXT: isinstance(x, str), LIST: isinstance(x, list), MAP: isinstance(x, dict),
        PAIR: isinstance(x, list) and len(x) == 2 and all(map(number, x)), URL: isinstance(x, str) and bool(re.match(r"https?://\S+$", x)),
        IDS: isinstance(x, int) or isinstance(x, str) and bool(re.fullmatch(r"\s*\d+(\s*,\s*\d+)*\s*", x)) or isinstance(x, list) and all(isinstance(v, int) for v in x),
    }[kind]


def validate(tree, shape=SHAPE, at: str = "") -> list[str]:
    """What is wrong, one line each; empty if nothing is. Missing settings have defaults, unknown ones are wrong."""
    if isinstance(shape, str):
        return [] if tree is None or _fits(shape, tree) else [f"{at}: {shape} expected, not {tree!r}"]
    if isinstance(shape, list):
        if not isinstance(tree, list):
            return [f"{at}: list expected"]
        return [e for i, x in enumerate(tree) for e in validate(x, shape[0], f"{at}[{i}]")]
    if not isinstance(tree, dict):
        return [f"{at or 'settings'}: map expected"]
    out = [f"{at}.{k}: unknown".lstrip(".") for k in tree if k not in shape]
    return out + [e for k, x in tree.items() if k in shape for e in validate(x, shape[k], f"{at}.{k}".lstrip("."))]


@dataclass
class Settings:
    bounds: dict[int, dict[str, tuple[float, float]]] = field(default_factory=dict)
    defaults: dict[str, tuple[float, float]] = field(default_factory=dict)
    rules: list[Rule] = field(default_factory=list)
    zscore_window: str | None = None
    location_window: str | None = None
    max_speed: float | None = None
    max_acceleration: float | None = None
    dry_run: bool = True
    reset_flags: bool = False
    take_new_feature_flags: bool = True

    @staticmethod
    def of(tree: dict) -> Settings:
        tree = resolve(tree)
        if wrong := validate(tree):
            raise ValueError("; ".join(wrong))
        pairs = lambda d: {k: tuple(map(float, d[k])) for k in ("range", "gradient", "zscore") if d.get(k)}
        rules = [
            Rule(int(r["independent"]), Rule.ids(r["dependent"]), str(r.get("dt_tolerance", "0.5s")), pairs(r.get("QC") or {}).get("range"), r.get("dt_stabilization"), r.get("max_allowed_downtime"))
            for r in tree.get("QC_dependent") or []
        ]
        whole, place, reset = tree.get("QC_global") or {}, tree.get("location") or {}, tree.get("reset") or {}
        return Settings(
            {int(r["id"]): pairs(r) for r in tree.get("QC") or []},  # of two entries of an id the last holds
            {k: tuple(map(float, v["range"])) for k, v in whole.items() if v.get("range")},
            rules, (whole.get("zscore") or {}).get("time_window"), place.get("time_window"), place.get("max_dx_dt"), place.get("max_ddx_dtdt"),
            bool((tree.get("data_api") or {}).get("dry_run", True)), bool(reset.get("overwrite_flags", False)), bool(reset.get("overwrite_feature_flags", True)),
        )


def load(path: str, changes: list[str] | None = None) -> Settings:
    import yaml

    return Settings.of(override(yaml.safe_load(Path(path).read_text()), changes or []))


def main(args: list[str] | None = None) -> int:
    """Validate files: --file, or every YAML file in --folder."""
    import yaml

    parser = argparse.ArgumentParser(description="Validate settings")
    parser.add_argument("--file")
    parser.add_argument("--folder")
    a = parser.parse_args(args)
    files = [Path(a.file)] if a.file else sorted(Path(a.folder or ".").glob("*.y*ml"))
    bad = 0
    for f in files:
        wrong = validate(resolve(yaml.safe_load(f.read_text()) or {}))
        bad += bool(wrong)
        print(f"{f}: {'; '.join(wrong) or 'valid'}")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
