"""Operations for large training-text pipelines; nothing else in bandloom imports this subpackage."""
