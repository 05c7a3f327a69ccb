"""Column-name presets.  Operators take names as arguments; these are defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ReviewColumns:
    age: str = "age"
    title: str = "title"
    text: str = "review_text"
    rating: str = "rating"
    recommended: str = "recommended_ind"
    feedback: str = "positive_feedback_count"
    division: str = "division_name"
    department: str = "department_name"
    klass: str = "class_name"
    numeric: tuple[str, ...] = field(
        default=("age", "rating", "recommended_ind", "positive_feedback_count")
    )
    categorical: tuple[str, ...] = field(default=("division_name", "department_name", "class_name"))


REVIEW = ReviewColumns()
