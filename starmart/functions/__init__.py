"""Column rules: native expressions only, so every rule stays inside code generation."""
