"""operators of seqloom."""
