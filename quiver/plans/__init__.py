"""Plan-level helpers: session and checkpoint folder, size-checked broadcast banks,
per-key top-k, the block (cogroup) path and plan inspection."""
