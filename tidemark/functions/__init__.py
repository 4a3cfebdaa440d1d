"""Row-wise column expressions; everything here stays inside code generation."""
