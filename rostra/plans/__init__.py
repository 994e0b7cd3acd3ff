"""The jobs: documents, dates, mentions, stance, gold tables and quality metrics."""
