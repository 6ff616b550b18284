"""Configuration: YAML or JSON, checked as a whole before any job runs."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from pathlib import Path

import yaml

from .functions.scoring import DIMENSIONS

DISCOVERY = ("auto", "rss", "static", "browser", "playwright", "sitemap")
FETCH = ("auto", "static", "browser", "playwright")
RSS_DATES = ("feed_fields", "url_pattern", "both")


class ConfigError(ValueError):
    """All that is wrong with a configuration, one line each."""


@dataclass(frozen=True)
class Schema:
    schema_id: str
    display_name: str = ""
    system_message: str = ""
    dimensions: dict = field(default_factory=dict)
    practice_areas: tuple[str, ...] = ()
    thresholds: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Category:
    name: str
    keywords: tuple[str, ...] = ()
    relevance_schema: Schema | None = None


@dataclass(frozen=True)
class Source:
    url: str
    categories: tuple[str, ...] = ()
    listings_type: str = "linked"
    discovery_method: str = "auto"
    fetch_method: str = "auto"
    rss_feed_url: str | None = None
    sitemap_url: str | None = None
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    date_selectors: tuple[str, ...] = ()
    date_patterns: tuple[str, ...] = ()
    rss_date_extraction: str = "both"
    item_selector: str | None = None
    browser_actions: tuple[dict, ...] = ()


@dataclass(frozen=True)
class Folder:
    folder_path: str
    archive_folder: str | None = None
    categories: tuple[str, ...] = ()


@dataclass(frozen=True)
class Preparation:
    enabled: bool = True
    min_prepared_chars: int = 600
    min_article_ratio: float = 0.25
    warn_margin: float = 0.10


@dataclass(frozen=True)
class Config:
    pipeline_version: str
    categories: tuple[Category, ...]
    web_sources: tuple[Source, ...] = ()
    email_folders: tuple[Folder, ...] = ()
    article_max_age_days: int = 3
    keyword_filter_enabled: bool = True
    bonus_rule: bool = False
    preparation: Preparation = Preparation()
    webhook_url: str | None = None

    @property
    def keywords(self) -> dict[str, list[str]]:
        return {c.name: list(c.keywords) for c in self.categories}

    @property
    def schemas(self) -> dict[str, str]:
        return {c.name: c.relevance_schema.schema_id for c in self.categories if c.relevance_schema}

    def to_dict(self) -> dict:
        """What ``from_dict`` reads, without values that are the defaults."""
        put = lambda d: {k: v for k, v in d.items() if v not in (None, (), [], {}, "")}

        def source(s: Source) -> dict:
            base = Source(s.url)
            own = {k: getattr(s, k) for k in ("listings_type", "discovery_method", "fetch_method", "rss_feed_url", "sitemap_url", "rss_date_extraction", "item_selector") if getattr(s, k) != getattr(base, k)}
            rules = put({"include_patterns": list(s.include), "exclude_patterns": list(s.exclude)})
            dated = put({"css_selectors": list(s.date_selectors), "regex_patterns": list(s.date_patterns)})
            return put({"url": s.url, "categories": list(s.categories), **own, "extraction_rules": rules, "date_extraction_pattern": dated, "browser_actions": list(s.browser_actions)})

        categories = [put({"name": c.name, "keywords": list(c.keywords), "relevance_schema": put(dict(c.relevance_schema.__dict__) | {"practice_areas": list(c.relevance_schema.practice_areas)}) if c.relevance_schema else None}) for c in self.categories]
        folders = [put({"folder_path": f.folder_path, "archive_folder": f.archive_folder, "categories": list(f.categories)}) for f in self.email_folders]
        prep = {k: v for k, v in self.preparation.__dict__.items() if v != getattr(Preparation(), k)}
        flags = ({"article_max_age_days": self.article_max_age_days} if self.article_max_age_days != 3 else {}) | ({} if self.keyword_filter_enabled else {"keyword_filter_enabled": False}) | ({"relevance_scoring_bonus_rule_enabled": True} if self.bonus_rule else {})
        return put({"pipeline_version": self.pipeline_version, "categories": categories, "web_sources": [source(s) for s in self.web_sources], "email_folders": folders, "article_preparation": prep, "webhook_url": self.webhook_url}) | flags

    def for_site(self, site: str) -> Config:
        """Only the sources whose URL has ``site`` in it, dots and case aside."""
        plain = lambda s: s.lower().replace(".", "")
        found = tuple(s for s in self.web_sources if site.lower() in s.url.lower() or plain(site) in plain(s.url))
        if not found:
            raise ValueError(f"no source matches {site!r}; there are: " + ", ".join(s.url for s in self.web_sources))
        return self.__class__(**{**self.__dict__, "web_sources": found, "email_folders": ()})


def _schema(raw: dict | None, where: str, errors: list[str]) -> Schema | None:
    if not raw:
        return None
    dims = raw.get("dimensions") or {}
    if missing := sorted(set(DIMENSIONS) - set(dims)):
        errors.append(f"{where}: dimensions missing: {', '.join(missing)}")
    if unknown := sorted(set(dims) - set(DIMENSIONS)):
        errors.append(f"{where}: dimensions unknown: {', '.join(unknown)}")
    for name, d in dims.items():
        scores = {str(k): v for k, v in ((d or {}).get("scores") or {}).items()}
        if set(scores) != {"0", "1", "2", "3"} or not all(scores.values()):
            errors.append(f"{where}: {name} needs scores 0 to 3")
        errors.extend(f"{where}: {name} needs a {k}" for k in ("label", "question") if not (d or {}).get(k))
    if not raw.get("schema_id"):
        errors.append(f"{where}: schema_id is empty")
    return Schema(raw.get("schema_id") or "", raw.get("display_name") or "", raw.get("system_message") or "", dims, tuple(raw.get("practice_areas") or ()), raw.get("thresholds") or {})


def from_dict(raw: dict) -> Config:
    """Check a raw configuration; raises one error that lists all faults."""
    errors: list[str] = []
    if not raw.get("pipeline_version"):
        errors.append("pipeline_version is empty")
    categories = list(raw.get("categories") or [])
    if not categories and raw.get("keywords"):
        categories = [{"name": "general", "keywords": raw["keywords"]}]
    if not categories:
        errors.append("there is no category")
    built = [Category(c.get("name") or "", tuple(c.get("keywords") or ()), _schema(c.get("relevance_schema"), f"category {c.get('name')!r}", errors)) for c in categories]
    names = [c.name for c in built]
    errors += ["a category has no name"] * (not all(names)) + [f"category {n!r} is there twice" for n in sorted({n for n in names if names.count(n) > 1})]
    ids = [c.relevance_schema.schema_id for c in built if c.relevance_schema]
    errors += [f"schema_id {i!r} is there twice" for i in sorted({i for i in ids if ids.count(i) > 1})]

    sources = []
    for s in raw.get("web_sources") or []:
        rules, dated = s.get("extraction_rules") or {}, s.get("date_extraction_pattern") or {}
        x = Source(
            s.get("url") or "", tuple(s.get("categories") or names), s.get("listings_type") or "linked", s.get("discovery_method") or "auto", s.get("fetch_method") or "auto",
            s.get("rss_feed_url"), s.get("sitemap_url"), tuple(rules.get("include_patterns") or ()), tuple(rules.get("exclude_patterns") or ()),
            tuple(dated.get("css_selectors") or ()), tuple(dated.get("regex_patterns") or ()), s.get("rss_date_extraction") or "both", s.get("item_selector"), tuple(s.get("browser_actions") or ()),
        )
        if not x.url:
            errors.append("a web source has no url")
        errors += [f"{x.url}: category {c!r} is unknown" for c in x.categories if c not in names]
        for key, allowed in (("discovery_method", DISCOVERY), ("fetch_method", FETCH), ("rss_date_extraction", RSS_DATES)):
            if getattr(x, key) not in allowed:
                errors.append(f"{x.url}: {key} {getattr(x, key)!r} is none of {', '.join(allowed)}")
        sources.append(x)
    folders = [Folder(f.get("folder_path") or "", f.get("archive_folder"), tuple(f.get("categories") or names)) for f in raw.get("email_folders") or []]
    errors += ["an e-mail folder has no folder_path"] * any(not f.folder_path for f in folders)
    if not sources and not folders:
        errors.append("there is neither a web source nor an e-mail folder")

    age = raw.get("article_max_age_days", 3)
    if isinstance(age, bool) or not isinstance(age, int) or age < 1:
        errors.append("article_max_age_days must be a whole number from 1")
    flags = {k: raw.get(k, d) for k, d in (("keyword_filter_enabled", True), ("relevance_scoring_bonus_rule_enabled", False))}
    errors += [f"{k} must be true or false" for k, v in flags.items() if not isinstance(v, bool)]
    if errors:
        raise ConfigError("\n".join(errors))
    prep = raw.get("article_preparation") or {}
    known = {k: prep[k] for k in Preparation.__dataclass_fields__ if k in prep}
    return Config(raw["pipeline_version"], tuple(built), tuple(sources), tuple(folders), age, flags["keyword_filter_enabled"], flags["relevance_scoring_bonus_rule_enabled"], Preparation(**known), os.environ.get("WEBHOOK_URL") or raw.get("webhook_url"))


def load(path: str | None = None, folder: str = ".") -> Config:
    """From a file, or the first of config.yaml, config.yml and config.json in a
    folder; a sources.yaml beside it fills in keys that are missing."""
    found = Path(path) if path else next((p for n in ("config.yaml", "config.yml", "config.json") if (p := Path(folder, n)).exists()), None)
    if found is None or not found.exists():
        raise FileNotFoundError(path or f"no configuration in {folder}")
    read = lambda p: (json.loads(p.read_text("utf-8-sig")) if p.suffix == ".json" else yaml.safe_load(p.read_text("utf-8-sig"))) or {}
    raw = read(found)
    if (more := found.with_name("sources.yaml")).exists():
        raw = read(more) | raw
    return from_dict(raw)
