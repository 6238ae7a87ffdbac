"""What the HTML reader must know of tags."""

# Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
HIDDEN = frozenset(("script", "style", "noscript"))
