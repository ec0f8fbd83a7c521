"""The same stateless operators on streams of captured pages."""
