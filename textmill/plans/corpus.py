"""The whole job: crawl records to token sequences, with both ways to remove duplicates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from textmill.operators.domains import domain_filter
from textmill.operators.exact import dedup_compare, exact_dedup
from textmill.operators.extract import html_extract
from textmill.operators.funnel import stage_funnel
from textmill.operators.language import LANG, THRESHOLD, LanguageModel, lang_filter
from textmill.operators.neardup import NearDupConfig, near_dedup
from textmill.operators.tokens import tokenize_fixed
from textmill.plans.steps import Step, StepRun, contract_faults
from textmill.schemas import STEP_CONTRACTS, check_step
from textmill.session import cut


@dataclass(frozen=True)
class CorpusConfig:
    lang: str = LANG
    threshold: float = THRESHOLD
    near: NearDupConfig = field(default_factory=NearDupConfig)
    keep: str = "cluster"
    max_length: int = 512


@dataclass(frozen=True)
class Corpus:
    """Every step's table; steps 2 to 5 are written to the shared folder once and read from there."""

    filtered: DataFrame
    extracted: DataFrame
    english: DataFrame
    near_unique: DataFrame
    exact_unique: DataFrame
    tokens_near: DataFrame
    tokens_exact: DataFrame

    def funnel(self) -> DataFrame:
        """Counts of steps 2 to 6 with both tails, each starting from step 4."""
        return stage_funnel(
            [
                ("2_domain_filter", None, self.filtered),
                ("3_html_extract", "2_domain_filter", self.extracted),
                ("4_lang_filter", "3_html_extract", self.english),
                ("5a_near_dedup", "4_lang_filter", self.near_unique),
                ("5b_exact_dedup", "4_lang_filter", self.exact_unique),
                ("6a_tokenize", "5a_near_dedup", self.tokens_near),
                ("6b_tokenize", "5b_exact_dedup", self.tokens_exact),
            ]
        )

    def compare(self) -> DataFrame:
        return dedup_compare(self.near_unique, self.exact_unique, "warc_id")


def extract_english(pages: DataFrame, blacklist: DataFrame, model: LanguageModel, cfg: CorpusConfig = CorpusConfig()):
    """Steps 2 to 4; returns the three tables."""
    columns = ["warc_id", "url", "date", "html_content"]
    filtered = cut(check_step(domain_filter(pages.select(*columns), blacklist).select(*columns), 2), "filtered")
    extracted = cut(check_step(html_extract(filtered), 3), "extracted")
    english = lang_filter(extracted, "extracted_text", model, cfg.lang, cfg.threshold)
    english = cut(english.select("warc_id", "url", "date", "extracted_text"), "english")
    return filtered, extracted, check_step(english, 4)


def drop_exact(english: DataFrame) -> DataFrame:
    """Step 5b: the earliest record of each text."""
    return check_step(exact_dedup(english, "extracted_text", ["date", "warc_id"]), 5)


def drop_near(english: DataFrame, cfg: CorpusConfig = CorpusConfig()) -> DataFrame:
    """Step 5a: one record of each group of near duplicates."""
    return check_step(near_dedup(english, "warc_id", "extracted_text", cfg.near, cfg.keep), 5)


def prepare_corpus(
    pages: DataFrame, blacklist: DataFrame, model: LanguageModel, cfg: CorpusConfig = CorpusConfig()
) -> Corpus:
    filtered, extracted, english = extract_english(pages, blacklist, model, cfg)
    near, exact = cut(drop_near(english, cfg), "near"), cut(drop_exact(english), "exact")
    return Corpus(
        filtered=filtered,
        extracted=extracted,
        english=english,
        near_unique=near,
        exact_unique=exact,
        tokens_near=check_step(tokenize_fixed(near, max_length=cfg.max_length), 6),
        tokens_exact=check_step(tokenize_fixed(exact, max_length=cfg.max_length), 6),
    )


def corpus_steps(
    pages: DataFrame, blacklist: DataFrame, model: LanguageModel, cfg: CorpusConfig = CorpusConfig(), limit: float = 1.0
) -> list[Step]:
    """The job's steps with their contracts' nulls and empty values counted while they are written;
    a step fails where more than a share ``limit`` of its rows has one."""
    columns = ["warc_id", "url", "date", "html_content"]

    def english(extracted: DataFrame) -> DataFrame:
        kept = lang_filter(extracted, "extracted_text", model, cfg.lang, cfg.threshold)
        return check_step(kept.select("warc_id", "url", "date", "extracted_text"), 4)

    def tokens(texts: DataFrame) -> DataFrame:
        return check_step(tokenize_fixed(texts, max_length=cfg.max_length), 6)

    def step(number: int, name: str, reads: tuple[str, ...], make) -> Step:
        return Step(name, reads, make, contract_faults(STEP_CONTRACTS[number]), limit)

    return [
        step(2, "filtered", (), lambda: check_step(domain_filter(pages.select(*columns), blacklist).select(*columns), 2)),
        step(3, "extracted", ("filtered",), lambda filtered: check_step(html_extract(filtered), 3)),
        step(4, "english", ("extracted",), english),
        step(5, "near_unique", ("english",), lambda texts: drop_near(texts, cfg)),
        step(5, "exact_unique", ("english",), drop_exact),
        step(6, "tokens_near", ("near_unique",), tokens),
        step(6, "tokens_exact", ("exact_unique",), tokens),
    ]


def run_corpus(
    spark: SparkSession, folder: str, pages: DataFrame, blacklist: DataFrame, model: LanguageModel,
    cfg: CorpusConfig = CorpusConfig(), limit: float = 1.0, key: str = "",
) -> tuple[DataFrame, DataFrame, StepRun]:
    """``tokens_near``, ``tokens_exact`` and the finished run with every step's counts.

    What ``prepare_corpus`` does, with both tails at the same time, tables removed after their last
    reader, and a job that broke off taken up at its first unfinished step.
    """
    run = StepRun(spark, folder, corpus_steps(pages, blacklist, model, cfg, limit), key)
    tables = run.run(["tokens_near", "tokens_exact"])
    return tables["tokens_near"], tables["tokens_exact"], run
