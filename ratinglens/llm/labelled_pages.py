"""The small labelled table from which the block classifier is trained: page layouts with the label of each block.

In these layouts ``+9`` stands for nine words of main text and ``-9`` for nine words of anything else, with a full stop
where they end a sentence. They are written by hand after common page layouts, not taken from any table.
"""

import re

NAV = "<nav><ul><li><a>-1</a></li><li><a>-1</a></li><li><a>-2</a></li></ul></nav>"
LIST = "<ul><li><a>-1</a></li><li><a>-2</a></li><li><a>-1</a></li><li><a>-3</a></li></ul>"

LAYOUTS = (
    # marked-up articles
    f"{NAV}<div class=ad>-8.</div><article><h1>+5</h1><p>+60.</p><p>+35.</p><p>+4.</p><p>+50.</p></article><footer>-9</footer>",
    f"{NAV}<div class=banner><a>-4</a></div><article><h1>+3</h1><p>+1.</p></article><footer>-12.</footer>",
    f"{NAV}<article><p>+2</p><p>+9</p><p>+1</p><p>+14.</p></article><footer><a>-2</a> -6</footer>",
    "<article><h1>+8</h1><p>+2</p><h2>+2</h2><p>+3</p><p>+30</p></article>",
    "<header><h1>-2</h1><p>-6.</p></header><article><header><h1>+7</h1><p>-5</p></header><p>+40.</p><p>+10.</p></article><aside><h2>-2</h2><p>-30.</p></aside>",
    f"<header><a>-2</a>{NAV}</header><main><h1>+5</h1><p>+25.</p><ul><li>+6</li><li>+4</li><li>+9.</li></ul><p>+18.</p></main><footer>-4</footer>",
    f"<main><article><h1>+6</h1><p>+45.</p><p>+20.</p></article><section class=comments><h2>-1</h2><p>-3</p><p>-25.</p><p>-40.</p></section></main>{NAV}",
    "<main><h1>+4</h1><div class=share><a>-1</a> <a>-1</a></div><p>+33.</p><div class=related><h3>-2</h3><a>-6</a> <a>-7</a></div><p>+28.</p></main>",
    "<article class=comment><p>-2</p><p>-22.</p></article><article class=comment><p>-35.</p></article><article><h1>+5</h1><p>+50.</p></article>",
    "<article><h1>+6</h1><p>+30.</p><form><p>-5.</p><p>-12.</p></form><p>+26.</p><aside><p>-20.</p></aside><p>+15.</p></article>",
    "<article><h1>+4</h1><blockquote><p>+18.</p></blockquote><p>+40.</p><table><tr><td>+1</td><td>+2</td></tr></table><pre>+12</pre></article>",
    "<article><p>+40.</p><ul><li><a>-4</a></li><li><a>-6</a></li><li><a>-5</a></li></ul></article><footer>-3</footer>",
    "<article><p>+40.</p><p><a>+3</a> +12.</p><p>+30.</p><p>+2 <a>+2</a>.</p><p>+30.</p></article>",
    "<article><p>+20 <a>+6</a> +8 <a>+9</a>.</p><p>+12 <a>+10</a> +6.</p><p><a>+8</a> +15 <a>+4</a>.</p><p>+3 <a>+4</a></p></article>",
    "<main><h2>+3</h2><p>+9 <a>+9</a>.</p><p>+40 <a>+25</a> +3.</p><ul><li>+4 <a>+3</a></li><li><a>+2</a> +6</li></ul></main>",
    # headers of the site and of the article
    "<header><h1>-9</h1><p>-12.</p></header><article><header><h1>+3</h1><p>-4</p></header><p>+40.</p></article>",
    "<article><header><h1>+6</h1></header><p>+50.</p><p>+20.</p></article>",
    "<main><article><header><p>-3</p><h1>+9</h1></header><p>+70.</p></article></main>",
    "<header><p>-8.</p><h2>-7</h2></header><main><article><header><h2>+2</h2><p>-9</p></header><p>+33.</p></article></main>",
    "<div class=masthead><h1>-8</h1><p>-14.</p></div><div class=content><h1>+4</h1><p>+44.</p></div>",
    "<div class=topbar><p>-11.</p><p>-7</p></div><article><div class=article-header><h1>+5</h1><div>-7</div></div><p>+50.</p></article>",
    # articles named by class or id only
    f"<div id=menu>{LIST}</div><div id=content><h1>+5</h1><p>+55.</p><p>+6.</p><p>+42.</p></div><div id=sidebar><p>-15.</p>{LIST}</div><div id=footer>-9</div>",
    f"<div class=header><h1>-3</h1></div><div class=post-body><h2>+4</h2><p>+2.</p><p>+31.</p><p>+7</p></div><div class=comments><p>-40.</p><p>-4.</p></div>{LIST}",
    "<div class=cookie-notice><p>-20.</p><a>-1</a></div><div class=entry-content><h1>+3</h1><p>+70.</p><p>+20.</p></div><div class=newsletter><p>-14.</p></div>",
    f"<div class=site-header><p>-4</p></div>{LIST}<div class=story><p>+11.</p><p>+3.</p><p>+90.</p></div><div class=promo><h3>-5</h3><p>-30.</p></div>",
    "<div class=main-content><div class=notice>-18.</div><h1>+6</h1><p>+24.</p><p>+5.</p><div class=share>-2</div></div><div class=copyright>-8</div>",
    "<div class=content><p>+12</p><p>+8</p><p>+5</p></div><div class=sidebar><h3>-2</h3><p>-60.</p><p>-45.</p></div>",
    f"<div class=article-text><p>+25 <a>+8</a> +5.</p><p>+10 <a>+5</a>.</p></div><div class=sidebar><p>-30 <a>-3</a>.</p>{LIST}</div>",
    # nothing named: words and links of a block and its neighbours have to do
    f"{LIST}<h1>+6</h1><p>+60.</p><p>+45.</p><p>+8.</p><p>+50.</p><p>-2 <a>-3</a></p><p><a>-2</a> <a>-2</a></p>",
    f"<div><a>-2</a> <a>-1</a> <a>-3</a></div><h1>+5</h1><div>+80.</div><div>+30.</div><div>+14.</div><div>+65.</div>{LIST}<div>-6</div>",
    f"{LIST}<h2>+4</h2><p>+35.</p><p>+22.</p><p>+12.</p><p>+28.</p>{LIST}<p>-7</p>",
    f"<p><a>-1</a></p><p><a>-2</a></p><h1>+7</h1><p>+48.</p><h2>+3</h2><p>+52.</p><p>+16.</p><p>+33.</p>{LIST}",
    f"{LIST}<p>-4</p><p>-5 <a>-3</a></p>{LIST}<p>-3</p>",
    f"<div>-3</div>{LIST}<div>+120.</div><div>+95.</div><div>-4 <a>-2</a></div>{LIST}",
    f"<td><a>-2</a></td><td>+75.</td><td>+40.</td><td>+20.</td><td>+55.</td><td><a>-3</a></td>{LIST}<td>-5</td>",
    f"<p>+44.</p><p>+37.</p><p>+9.</p><p>+58.</p>{LIST}",
    "<p>+15.</p>", "<p>+60.</p>", "<h1>+4</h1><p>+6.</p>", "+30.", "<p>+3</p>",
    f"<aside><p>-50.</p><p>-44.</p></aside><p>+40.</p><p>+38.</p>{LIST}",
    "<footer><p>-30.</p><p>-25.</p></footer><p>+41.</p><form><p>-16.</p></form>",
)


def labelled_html(layout: str) -> str:
    """The layout with words for its numbers; the first word of a block of main text is ``keep``."""
    def words(found: re.Match) -> str:
        sign, count, stop = found.groups()
        return " ".join(["keep" if sign == "+" else "drop"] + ["word"] * (int(count) - 1)) + stop
    return re.sub(r"(?<![\w=-])([+-])(\d+)(\.?)", words, layout)
