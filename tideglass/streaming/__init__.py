"""File streams that take up where they stopped."""
