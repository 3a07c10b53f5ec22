"""Row-set operators: frames in, frames out."""
