"""Thresholds and weights; the defaults are those that take effect in production."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RuleConfig:
    min_text_length: int = 100
    min_avg_line_length: float = 5
    min_chinese_ratio: float = 0.6
    max_symbol_ratio: float = 0.2
    max_internal_dup_ratio: float = 0.5
    max_vertical_bar_ratio: float = 0.005
    max_comma_ratio: float = 0.05
    max_url_density: float = 0.01
    max_emoji_ratio: float = 0.02
    ngram: int = 13


@dataclass(frozen=True)
class FeatureConfig:
    max_feature_words_per_line: float = 0.2
    mode: str = "shortest"  # or "all": overlapping matches, case kept


@dataclass(frozen=True)
class PerplexityConfig:
    ppl_threshold: float = 200.0
    max_ppl: float = 10000.0
    segment_chars: int = 500
    compat_emoji: bool = True
    order: int = 3


@dataclass(frozen=True)
class ClusterConfig:
    similarity_threshold: float = 0.85
    min_cluster_size: int = 3


@dataclass(frozen=True)
class EngineConfig:
    quality_threshold: float = 0.8
    weights: tuple[tuple[str, float], ...] = (("rule_score", 0.3), ("feature_score", 0.5), ("perplexity_score", 0.1), ("clustering_score", 0.1))
    enabled: tuple[str, ...] = ("rule_score", "feature_score")
    rule: RuleConfig = field(default_factory=RuleConfig)
    feature: FeatureConfig = field(default_factory=FeatureConfig)
    perplexity: PerplexityConfig = field(default_factory=PerplexityConfig)
    cluster: ClusterConfig = field(default_factory=ClusterConfig)
