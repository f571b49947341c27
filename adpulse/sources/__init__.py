from adpulse.sources.bundle import Bundle, load_bundle, DATE_COLUMN, TABLES  # noqa: F401
