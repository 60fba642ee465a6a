"""Configuration of a run: defaults, deep merge, and the checks between its parts."""

from __future__ import annotations


def deep_merge(base: dict, over: dict) -> dict:
    """All keys of both, those of ``base`` first. A key of one side keeps its value; where both
    values are dictionaries they are merged in turn, else the second side's value holds."""
    merged = {}
    for key in [*base, *(k for k in over if k not in base)]:
        sides = [side[key] for side in (base, over) if key in side]
        merged[key] = deep_merge(*sides) if len(sides) == 2 and all(isinstance(v, dict) for v in sides) else sides[-1]
    return merged


def one_source(dataset: dict, sources: tuple[str, str] = ("guide_calls_csv", "h5ad")) -> str:
    """Which of two sources of labels a data set names; both and none are errors."""
    named = [s for s in sources if dataset.get(s)]
    if len(named) != 1:
        raise ValueError("exactly one of " + " and ".join(sources) + " must be given")
    return named[0]


def enabled_datasets(config: dict) -> list[str]:
    """The names of the datasets switched on, in order."""
    return [n for n, d in config.get("datasets", {}).items() if d.get("enabled", True)]


def check_config(config: dict) -> list[str]:
    """What is wrong with a configuration, in words; nothing where it is sound."""
    wrong = []
    methods = {m for m, on in config.get("methods", {}).items() if on}
    if "comparison" in methods and not {"mixscape", "mixscale", "ps"} <= methods:
        wrong.append("comparison needs mixscape, mixscale and ps")
    if "target_random" in methods and not config.get("targets"):
        wrong.append("target_random needs a target list")
    if "ps_de" in methods and "ps" not in methods:
        wrong.append("ps_de needs ps")
    if "target_random" in methods and not methods & {"mixscape", "mixscale"}:
        wrong.append("target_random needs the cells of mixscape or mixscale")
    for stream in config.get("streams", []):
        if stream not in methods:
            wrong.append(f"stream {stream} has no method that makes it")
    if "ora" in methods and "global_de" not in methods and "mixscape" not in methods:
        wrong.append("ora needs a differential-expression stream")
    for name, d in config.get("datasets", {}).items():
        if bool(d.get("guide_calls_csv")) and not d.get("pert_col"):
            wrong.append(f"{name}: no label column")
        if not d.get("control_label"):
            wrong.append(f"{name}: no control label")
    return wrong


def dataset_args(items: list[str]) -> dict[str, str]:
    """``NAME=path`` arguments; the last of equal names holds."""
    out = {}
    for item in items:
        name, sep, path = item.partition("=")
        if not sep or not name or not path:
            raise ValueError(f"not NAME=path: {item}")
        out[name] = path
    return out
