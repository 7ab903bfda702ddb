"""Whole jobs, put together from the operators."""

from tunesmith.plans.jobs import (
    StageFiles,
    compare_models,
    make_initial_responses,
    prepare_criteria,
    preference_split,
    revision_curriculum,
    revision_stage,
    sft_split,
)

__all__ = [
    "StageFiles",
    "compare_models",
    "make_initial_responses",
    "prepare_criteria",
    "preference_split",
    "revision_curriculum",
    "revision_stage",
    "sft_split",
]
