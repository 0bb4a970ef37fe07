"""A stand-in for a PDF renderer: pages are parts of the file."""


def pages(content: bytes) -> list[bytes]:
    if content.startswith(b"broken"):
        raise ValueError("no PDF")
    return content.split(b"|")
