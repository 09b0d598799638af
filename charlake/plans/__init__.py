from charlake.plans.feedback_table import build_feedback_table
from charlake.plans.typed_table import type_user_table
from charlake.plans.user_table import build_user_table, render_user_table

__all__ = ["build_feedback_table", "build_user_table", "render_user_table", "type_user_table"]
