"""Warehouse loaders: EAV observations -> wide typed visit tables."""
