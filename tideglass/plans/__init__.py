"""One job for each kind of source: from raw rows to canonical observations and rejections."""
