"""The marketplace itself: tables, views, checks and reports composed from operators."""
