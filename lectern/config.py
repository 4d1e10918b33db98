"""Pipeline manifests, overrides from the command line, and the registry of steps."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from dataclasses import replace
from string import Template
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern.model import Corpus
from lectern.operators import enrich, ingest, package, refine, report, resolve
from lectern.operators.meta import refresh
from lectern.operators.select import in_range, source_identity
from lectern.sources import readers, writers

def interpolate(node: Any, env: dict[str, str] | None = None) -> Any:
    """``$X`` and ``${X}`` in all strings replaced from the environment; unset ones stay."""
    known = dict(os.environ if env is None else env)
    match node:
        case str():
            return Template(node).safe_substitute(known)
        case list():
            return [interpolate(x, known) for x in node]
        case dict():
            return dict(zip(node, interpolate(list(node.values()), known)))
    return node


def literal(text: str) -> Any:
    """A command-line value: true/false, none, integers, and decimals with at most one digit before the point."""
    low = text.lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("none", "null"):
        return None
    if re.fullmatch(r"\d+", text):
        return int(text)
    return float(text) if re.fullmatch(r"\d?\.\d+", text) else text


def overrides(args: list[str]) -> dict[str, Any]:
    """``--name value`` pairs; a name without a value is true. Names that end in ``uuid`` stay strings."""
    out: dict[str, Any] = {}
    name = None
    for a in args:
        if a.startswith("--"):
            name, _, value = a[2:].partition("=")
            out[name] = (value if name.endswith("uuid") else literal(value)) if value else True
            name = None if value else name
        elif name:
            out[name] = a if name.endswith("uuid") else literal(a)
            name = None
    return out


def truthy(value: Any) -> bool:
    return value if isinstance(value, bool) else str(value).strip().lower() in ("true", "1", "yes")


def load(path: str, args: list[str] = (), env: dict[str, str] | None = None) -> dict[str, Any]:
    """A manifest with variables, overrides merged into ``parameters``, and its services checked."""
    import yaml

    with open(path, encoding="utf-8") as f:
        config = interpolate(yaml.safe_load(f) or {}, env)
    if not isinstance(config, dict) or not isinstance(config.get("pipeline"), list):
        raise ValueError(f"{path}: no list of steps under pipeline")
    for name, service in (config.get("services") or {}).items():
        if not isinstance(service, dict):
            raise ValueError(f"{path}: service {name} isn't a mapping")
    config["parameters"] = (config.get("parameters") or {}) | overrides(list(args))
    return config


Step = Callable[[Corpus, dict[str, Any]], Corpus]


def _given(p: dict[str, Any], *names: str) -> dict[str, Any]:
    return {k: p[k] for k in names if k in p}


def in_scope(step: Step) -> Step:
    """The step on the documents from ``start_uuid`` to ``stop_uuid`` only; the others stay as they are."""

    def scoped(corpus: Corpus, p: dict[str, Any]) -> Corpus:
        start, stop = p.get("start_uuid"), p.get("stop_uuid")
        if start is None and stop is None:
            return step(corpus, p)
        corpus = corpus.complete()
        inside = in_range(corpus.meta, start, stop)
        done, rest = step(corpus.only(inside), p), corpus.without(inside)
        return replace(rest.joined(done), ledger=done.ledger)

    return scoped


def _spark(corpus: Corpus) -> SparkSession:
    return corpus.meta.sparkSession


def _now(p: dict[str, Any]):
    return F.lit(p["recorded_at"]).cast("timestamp") if "recorded_at" in p else F.current_timestamp()


def _init(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    writers.stage_workspace(p["root"], list(p.get("volumes", ())))
    return corpus


def _acquire(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    readers.acquire(p["path"], p.get("fetch"))
    return corpus


def _ingest_conversations(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    new = ingest.conversations(readers.json_lines(_spark(corpus), p["path"]), corpus.ledger, _now(p), existing=corpus.meta, **_given(p, "source", "limit"))
    return corpus.joined(new)


def _ingest_forum(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    return ingest.threads(readers.forum_pages(_spark(corpus), p["path"], p.get("limit")), corpus, _now(p), **_given(p, "source"))


def _ingest_book(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    return corpus.joined(ingest.books(readers.book(_spark(corpus), p["path"], str(p["native_id"])), corpus.ledger, _now(p), **_given(p, "source")))


def _report(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    start, stop = p.get("start_uuid"), p.get("stop_uuid")
    part = corpus if start is None and stop is None else corpus.only(in_range(corpus.meta, start, stop))
    wrong = report.unknown_sections(p.get("report_sections") or [])
    # a table of all documents is shown in part, and the text tells how much more there is
    text = writers.text_report(report.report(part, p.get("report_sections")), p.get("rows", 1_000))
    _say("\n".join([text, *(f"no section {s}" for s in wrong)]), p)
    return corpus


def _report_records(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    m = corpus.meta.select("doc_uuid", source_identity().alias("source"))
    _say(writers.text_report({"records": {"sources": report.shares(m, "source"), "ranges": report.source_ranges(m, "doc_uuid", "source"), "samples": report.position_samples(m, "doc_uuid"), "orphans": report.ledger_orphans(corpus.meta, corpus.ledger)}}, p.get("rows", 1_000)), p)
    return corpus


def _say(text: str, p: dict[str, Any]) -> None:
    if "out" in p:
        with open(p["out"], "w", encoding="utf-8") as f:
            f.write(text + "\n")
    else:
        print(text)


def _propose_themes(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    axes = resolve.document_axes(corpus)
    tags = resolve.theme_tags(corpus.items).join(axes.drop("language").distinct(), "doc_uuid")
    rolled, rows = resolve.proposal(tags, ["genre", "sexuality", "violence", "toxicity"], **_given(p, "least", "cut"))
    writers.cluster_file(rolled, rolled.count()).coalesce(1).write.mode("overwrite").text(p["clusters"])
    writers.worklist_csv(rows, p["worklist"])
    return corpus


def _curate_themes(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    spark = _spark(corpus)
    return resolve.curate_corpus(corpus, resolve.curation_map(readers.decisions(spark, p["decisions"]), readers.cluster_manifest(spark, p["clusters"])))


def _package(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    start, stop = p.get("start_uuid"), p.get("stop_uuid")
    part = corpus if start is None and stop is None else corpus.only(in_range(corpus.meta, start, stop))
    writers.json_lines(package.documents_json(part.complete()), p["path"])
    return corpus


def _prepare(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    """Packaged lines by flavour, a folder each."""
    axes = resolve.document_axes(corpus).select("doc_uuid", package.flavour(F.col("sexuality"), F.col("toxicity")).alias("flavour")).distinct()
    package.documents_json(corpus.complete()).join(axes, "doc_uuid").select("flavour", "line").write.mode("overwrite").partitionBy("flavour").text(p["path"])
    return corpus


def _elsewhere(corpus: Corpus, p: dict[str, Any]) -> Corpus:
    """Training and publishing run on other machines; ``run`` in the parameters may bring a function of the corpus and them."""
    if not callable(p.get("run")):
        raise NotImplementedError("training and publishing are out of scope: give a function as parameter run")
    p["run"](corpus, p)
    return corpus


STEPS: dict[str, Step] = {
    "init": _init,
    "acquire": _acquire,
    "ingest-conversations": _ingest_conversations,
    "ingest-forum": _ingest_forum,
    "ingest-book": _ingest_book,
    "refine-cdm-html-to-markdown": in_scope(lambda c, p: refine.refine_markdown(c, **_given(p, "kinds", "preferred"))),
    "refine-cdm-language": in_scope(lambda c, p: refine.refine_language(c, p["samples"], **_given(p, "targets", "size", "least", "most", "mode"))),
    "refine-chat-safety-dials": in_scope(lambda c, p: enrich.refine_safety(c, p["backend"])),
    "refine-chat-genre-theme": in_scope(lambda c, p: enrich.refine_genre(c, p["backend"])),
    "refine-chat-characters": in_scope(lambda c, p: enrich.refine_characters(c, p["backend"])),
    "refine-chat-grammar": in_scope(lambda c, p: enrich.refine_grammar(c, p["backend"], budget=p.get("max_inference_budget"))),
    "scalpel-cdm-language": in_scope(lambda c, p: refine.scalpel_language(c)),
    "scalpel-cdm-html-to-markdown": in_scope(lambda c, p: refine.scalpel_markdown(c)),
    "scalpel-chat-characters": in_scope(lambda c, p: refine.scalpel_characters(c, p.get("pc_names"))),
    "scalpel-chat-genre-theme": in_scope(lambda c, p: refine.scalpel_genre_theme(c)),
    "scalpel-chat-safety-dials": in_scope(lambda c, p: refine.scalpel_safety_dials(c)),
    "scalpel-chat-grammar": in_scope(lambda c, p: refine.scalpel_grammar(c, p.get("healths"), truthy(p.get("character_reset_sentinel", False)))),
    "purge-cdm-corrupt": in_scope(lambda c, p: refine.purge_corrupt(c)),
    "purge-cdm-record": lambda c, p: refine.purge_records(c, p.get("target_uuid"), p.get("start_uuid"), p.get("stop_uuid")),
    "refresh-meta": in_scope(lambda c, p: refresh(c)),
    "report-cdm": _report,
    "report-cdm-records": _report_records,
    "resolve-theme-proposal": _propose_themes,
    "resolve-theme-curation": _curate_themes,
    "package": _package,
    "prepare": _prepare,
    "train": _elsewhere,
    "bake": _elsewhere,
}


def step(name: str, parameters: dict[str, Any] | None = None) -> Step:
    """The step of a name. ``verb-<dataset>-subject`` stands for the step of that verb and subject; ``ingest-<dataset>`` needs
    parameter ``format`` (conversations, forum or book). An unknown name is a KeyError."""
    if name in STEPS:
        return STEPS[name]
    verb, _, rest = name.partition("-")
    if verb == "ingest":
        return STEPS[f"ingest-{(parameters or {}).get('format')}"]
    subject = rest.partition("-")[2]
    return STEPS[next((k for k in STEPS if k.startswith(f"{verb}-") and subject and k.split("-", 2)[2:] == [subject]), name)]


def run(corpus: Corpus, config: dict[str, Any]) -> Corpus:
    """The steps of a manifest in order; an unknown step is an error before anything runs."""
    parameters, steps, unknown = config.get("parameters") or {}, [], []
    for n in config["pipeline"]:
        try:
            steps.append(step(n, parameters))
        except KeyError:
            unknown.append(n)
    if unknown:
        raise ValueError(f"unknown steps: {', '.join(unknown)}")
    for s in steps:
        corpus = s(corpus, parameters)
    return corpus
