"""Write semantics: merge algebra and file writers."""
