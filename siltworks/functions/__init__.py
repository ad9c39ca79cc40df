"""Column functions: text, hashing, conversations, judge replies."""
